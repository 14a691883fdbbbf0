"""Console output of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def print_stream(df: DataFrame, name: str, checkpoint: str, output_mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.format("console").queryName(name).outputMode(output_mode)
        .option("truncate", False).option("checkpointLocation", checkpoint).start()
    )
