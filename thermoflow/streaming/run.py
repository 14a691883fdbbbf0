"""Running a stream over what is there now and reading its result as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thermoflow.session import working_path
from thermoflow.sinks.points import store_batches


def drain(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> None:
    """Process all available input once, into a table of parquet files, and stop."""
    if output_mode == "append":
        query = (
            df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
        )
    else:
        query = store_batches(df, path, checkpoint, output_mode, availableNow=True)
    query.awaitTermination()


def drained(spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """The result of :func:`drain` in a fresh working folder, as a DataFrame."""
    path = working_path(spark, name)
    drain(df, path, working_path(spark, f"{name}-checkpoint"), output_mode)
    return spark.read.schema(df.schema).parquet(path)
