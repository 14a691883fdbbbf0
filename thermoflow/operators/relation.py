"""Ratio of the IN and OUT averages of a room in the same window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from thermoflow.fixed_values import AVERAGE_WINDOW, JOIN_WINDOW, SOURCE_IN, SOURCE_OUT
from thermoflow.functions.numeric import int_mean, ratio
from thermoflow.operators.projections import only_source


def _both_sides(readings: DataFrame, width: str, aggregate) -> DataFrame:
    side = {s: F.when(F.col("source") == s, F.col("temperature")) for s in (SOURCE_IN, SOURCE_OUT)}
    return (
        readings.groupBy(F.window("ts", width), "room_id")
        .agg(aggregate(side[SOURCE_IN]).alias("avg_in"), aggregate(side[SOURCE_OUT]).alias("avg_out"))
        .where(F.col("avg_in").isNotNull() & F.col("avg_out").isNotNull())
    )


def relation(readings: DataFrame, width: str = AVERAGE_WINDOW, ieee: bool = False) -> DataFrame:
    """``avg_in / avg_out`` per room and window that has readings of both sources.

    Both averages come from one grouping, so there is one shuffle of partial sums and,
    on a stream, one state store; a join of two aggregates needs twice that.
    """
    return _both_sides(readings, width, F.avg).select(
        "room_id",
        ratio(F.col("avg_in"), F.col("avg_out"), ieee).alias("relation"),
        F.col("window.end").alias("window_end"),
    )


def relation_by_join(
    readings: DataFrame,
    width: str = AVERAGE_WINDOW,
    join_width: str = JOIN_WINDOW,
    ieee: bool = False,
) -> DataFrame:
    """The same ratio as a windowed inner join of the two averages.

    The averages are put into windows of ``join_width`` by their own time, the last
    instant of their window, and joined on room and that window.
    """
    def side(source: str, name: str) -> DataFrame:
        averages = (
            only_source(readings, source)
            .groupBy(F.window("ts", width).alias("averaged"), "room_id")
            .agg(F.avg("temperature").alias(name))
        )
        return averages.select(
            "room_id", name, F.col("averaged.end").alias(f"{name}_end"),
            F.window(F.window_time("averaged"), join_width).alias("joined"),
        )

    joined = side(SOURCE_IN, "avg_in").join(side(SOURCE_OUT, "avg_out"), ["room_id", "joined"])
    return joined.select(
        "room_id",
        ratio(F.col("avg_in"), F.col("avg_out"), ieee).alias("relation"),
        F.col("avg_in_end").alias("window_end"),
    )


def int_relation(readings: DataFrame, width: str = JOIN_WINDOW, ieee: bool = False) -> DataFrame:
    """Ratio of the whole-number averages, as a double and as text."""
    def mean(side):
        return int_mean(F.sum(side), F.count(side))

    # An empty side has count 0; its sum is NULL and so is the mean, without a division by zero.
    def safe_mean(side):
        return F.when(F.count(side) > 0, mean(side))

    out = _both_sides(readings, width, safe_mean).select(
        "room_id",
        ratio(F.col("avg_in").cast("double"), F.col("avg_out").cast("double"), ieee).alias("relation"),
        F.col("window.end").alias("window_end"),
    )
    return out.withColumn("relation_text", F.col("relation").cast("string"))
