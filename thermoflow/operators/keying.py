"""Distribution of rows over tasks and files.

Grouping and windowing place rows by key on their own; these functions are for the
cases where a placement is wanted as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.functions.numeric import room_partition


def key_at(df: DataFrame, position: int) -> str:
    """The column at a position, to group by it: ``df.groupBy(key_at(df, 0))``."""
    return df.columns[position]


def rebalance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly over tasks, for sources with fewer partitions than cores.

    Without a number Spark sizes the partitions itself and splits uneven ones.
    """
    return df.hint("rebalance") if partitions is None else df.repartition(partitions)


def with_partition(df: DataFrame, room_id: Column | str, partitions: int, name: str = "partition") -> DataFrame:
    """Add the partition a room belongs to (room number modulo the number of partitions)."""
    room_id = F.col(room_id) if isinstance(room_id, str) else room_id
    return df.withColumn(name, room_partition(room_id, partitions))


def write_by_partition(df: DataFrame, path: str, room_id: str, partitions: int, day: str = "ts") -> None:
    """Store rows in folders per room partition and day, so that readers can skip both.

    Rows are rebalanced by folder first: each folder gets few files, and Spark splits
    the folders of busy rooms over several tasks.
    """
    placed = with_partition(df, room_id, partitions).withColumn("day", F.to_date(day))
    placed.hint("rebalance", F.col("partition"), F.col("day")).write.partitionBy("partition", "day").parquet(path)
