"""Readings laid out by room, so that groupings and joins by room and window need no shuffle.

Rows are shuffled once, when they are stored: into buckets by room and span of time, sorted within. A query that groups by room,
span and window, or joins such groups, finds all rows of a group in one bucket. The span spreads a hot room over as
many buckets as there are spans; it must be a multiple of the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermoflow.fixed_values import SOURCE_IN, SOURCE_OUT
from thermoflow.functions.numeric import ratio
from thermoflow.functions.time import as_micros, duration_micros

SPAN = "1 day"
#: Joins of groups that are laid out by some of the join's keys need no shuffle either with this setting.
JOIN_BY_LAYOUT = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def store_buckets(readings: DataFrame, table: str, path: str, buckets: int, span: str = SPAN) -> DataFrame:
    """Store readings as a table of buckets; one file per bucket and writing task, of which there is one per bucket."""
    micros = as_micros(F.col("ts"))
    placed = readings.withColumn("span", F.floor(micros / duration_micros(span)).cast("bigint"))
    (
        placed.repartition(buckets, "room_id", "span").write.bucketBy(buckets, "room_id", "span").sortBy("room_id", "span", "ts")
        .option("path", path).saveAsTable(table)
    )
    return readings.sparkSession.table(table)


def _checked(width: str, span: str) -> None:
    if duration_micros(span) % duration_micros(width):
        raise ValueError(f"windows of {width} do not fit into spans of {span}")


def bucketed_means(stored: DataFrame, width: str, span: str = SPAN, source: str | None = None, mean: str = "avg_temperature") -> DataFrame:
    """``room_id, span, window_end`` and the mean of a side (or of all), by buckets."""
    _checked(width, span)
    rows = stored if source is None else stored.where(F.col("source") == source)
    means = rows.groupBy("room_id", "span", F.window("ts", width)).agg(F.avg("temperature").alias(mean))
    return means.select("room_id", "span", F.col("window.end").alias("window_end"), mean)


def bucketed_relation(stored: DataFrame, width: str, span: str = SPAN) -> DataFrame:
    """The ratio of IN and OUT averages as a join of the two, bucket by bucket."""
    inside = bucketed_means(stored, width, span, SOURCE_IN, "avg_in")
    outside = bucketed_means(stored, width, span, SOURCE_OUT, "avg_out")
    joined = inside.hint("merge").join(outside, ["room_id", "span", "window_end"])
    return joined.select("room_id", ratio(F.col("avg_in"), F.col("avg_out")).alias("relation"), "window_end")


def layout_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which joins follow the layout. It shares stored tables."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(*JOIN_BY_LAYOUT)
    return session
