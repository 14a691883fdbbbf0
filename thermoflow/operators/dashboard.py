"""The queries behind the dashboard, over tables of points.

``as_of`` stands for the dashboard's "now"; by default it is the newest time in the
table, found by a scalar subquery inside the same query.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.fixed_values import (
    DASHBOARD_RANGE, GAUGE_MAX, GAUGE_MIN, GRID_MAX, GRID_MIN, LATEST_RANGE,
)
from thermoflow.functions.numeric import band, clamp
from thermoflow.functions.time import interval
from thermoflow.operators.ordered import running_totals


def _now(points: DataFrame, as_of: datetime | None) -> Column:
    if as_of is not None:
        return F.lit(as_of).cast(points.schema["time"].dataType)
    return points.agg(F.max("time")).scalar()


def series(points: DataFrame, time_range: str = DASHBOARD_RANGE, as_of: datetime | None = None) -> DataFrame:
    """One series per room: its values in the time range, ordered by room and time."""
    recent = points.where(F.col("time") >= _now(points, as_of) - interval(time_range))
    return recent.select("room", "time", "value").orderBy("room", "time")


def grid_cells(points: DataFrame, low: float = GRID_MIN, high: float = GRID_MAX) -> DataFrame:
    """Colour strength in [0, 1] of each ratio: square root scale over a clamped range."""
    scaled = F.sqrt((clamp(F.col("value"), low, high) - low) / (high - low))
    strength = F.when(F.col("value").isNotNull(), scaled)
    return points.select("room", "time", "value", strength.alias("strength"))


def latest(
    points: DataFrame, source: str, horizon: str = LATEST_RANGE, as_of: datetime | None = None
) -> DataFrame:
    """Latest value per room of a source, no older than the horizon (strictly)."""
    recent = points.where(
        (F.col("source") == source) & (F.col("time") > _now(points, as_of) - interval(horizon))
    )
    return recent.groupBy("room").agg(
        F.max("time").alias("time"), F.max_by("value", "time").alias("value")
    )


def gauge(values: DataFrame) -> DataFrame:
    """Band colour and filled share of the gauge for each value."""
    filled = (clamp(F.col("value"), GAUGE_MIN, GAUGE_MAX) - GAUGE_MIN) / (GAUGE_MAX - GAUGE_MIN)
    return values.withColumns({
        "band": band(F.col("value")),
        "filled": F.when(F.col("value").isNotNull(), filled),
    })


def alert_counter(alerted: DataFrame, bucket: str = "1 minute", slice_width: str = "1 day") -> DataFrame:
    """Alerts per time bucket and the count so far (per source).

    The count so far runs inside slices of ``slice_width``, so even years of buckets
    never meet in one task.
    """
    per_bucket = (
        alerted.groupBy(F.window("ts", bucket), "source")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select("source", F.col("window.start").alias("time"), "alerts")
    )
    return running_totals(
        per_bucket, ("source",), ("time",), {"alerts_so_far": F.col("alerts")},
        slice_by=F.window("time", slice_width)["start"],
    )


def reduce_series(points: DataFrame, keys: tuple[str, ...] = ("room",)) -> DataFrame:
    """Each series as single numbers: mean and last value."""
    return points.groupBy(*keys).agg(
        F.avg("value").alias("mean"), F.max_by("value", "time").alias("last")
    )
