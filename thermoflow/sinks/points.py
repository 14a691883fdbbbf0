"""Tables of points: batch writes, stream sinks and line-protocol files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from thermoflow.fixed_values import POINTS_COMPRESSION
from thermoflow.operators.points import as_lines


FOLDERS = ("measurement", "day")
#: How often files are written. A time-series store is flushed several times a second; tables of files
#: would get as many small files and a log that every reader has to list.
FILE_INTERVAL = "1 minute"


def _with_day(points: DataFrame) -> DataFrame:
    return points.withColumn("day", F.to_date("time"))


def write_points(points: DataFrame, path: str, mode: str = "append", compression: str = "zstd") -> None:
    """Store points by measurement and day, so that a query reads only the folders it asks for.

    Rows are rebalanced by folder first: a quiet day gets one file, a busy one several.
    """
    placed = _with_day(points).hint("rebalance", *[F.col(name) for name in FOLDERS])
    placed.write.mode(mode).option("compression", compression).partitionBy(*FOLDERS).parquet(path)


def write_lines(points: DataFrame, path: str, fields: dict[str, str] | None = None,
                per_file: int | None = None, compression: str = POINTS_COMPRESSION) -> None:
    """Store points as line-protocol text. ``per_file`` bounds the lines of a file, for loaders that need it."""
    lines = as_lines(points, fields)
    lines.write.option("maxRecordsPerFile", per_file or 0).option("compression", compression).text(path)


def store_points(points: DataFrame, path: str, checkpoint: str, name: str = "points", **trigger) -> StreamingQuery:
    """Stream points into a table, each exactly once (the sink's log names the valid files).

    ``trigger`` is passed to ``writeStream.trigger``; by default files are written every
    ``FILE_INTERVAL``, rebalanced by folder.
    """
    placed = _with_day(points).hint("rebalance", *[F.col(name) for name in FOLDERS])
    return (
        placed.writeStream.format("parquet").queryName(name).partitionBy(*FOLDERS).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FILE_INTERVAL}))
        .start(path)
    )


def store_batches(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                  partition_by: tuple[str, ...] = (), name: str = "batches", **trigger) -> StreamingQuery:
    """Stream any output mode into one folder per micro-batch.

    A batch that is run again after a failure replaces its own folder, so repeats leave
    no trace. This is also the shape for stores that Spark has no exact sink for.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch_id={batch_id}")

    return (
        df.writeStream.foreachBatch(write).queryName(name).outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FILE_INTERVAL}))
        .start()
    )


def compact_points(spark: SparkSession, path: str, target: str) -> None:
    """Copy a table of points into few files per folder, for days that are over."""
    days = spark.read.parquet(path)
    days.hint("rebalance", *[F.col(name) for name in FOLDERS]).write.mode("overwrite").partitionBy(*FOLDERS).parquet(target)


def read_points(
    spark: SparkSession, path: str, measurement: str | None = None, since: datetime | None = None
) -> DataFrame:
    """Stored points, of one measurement and from a time on if given: only those folders are read."""
    points = spark.read.parquet(path)
    if measurement is not None:
        points = points.where(F.col("measurement") == measurement)
    if since is not None:
        kind = points.schema["time"].dataType
        points = points.where((F.col("day") >= F.lit(since.date())) & (F.col("time") >= F.lit(since).cast(kind)))
    return points.drop("day")
