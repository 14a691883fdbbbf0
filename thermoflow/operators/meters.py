"""Meters: rates over sliding windows, and counters that start anew.

A sliding rate is made of *panes*: rows are counted per step first. A pane enters the window at its own step and leaves it a
width later, so it is two changes of a running sum, however many windows overlap. Rows are never copied per window, and the running sum
runs over slices of the steps (``ordered.running_totals``).

A scraped counter only rises while its process lives and starts at zero when it is started again. What it counted between two scrapes is their
difference, or the whole new value if it fell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from thermoflow.functions.time import as_micros, duration_micros, duration_seconds
from thermoflow.operators.ordered import ROWS_PER_SLICE, Slices, previous_row, running_totals


def sliding_throughput(
    df: DataFrame, width: str = "5 seconds", step: str = "1 second", ts: str = "ts", keys: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``keys, time, events, per_second``: events of the last ``width`` at the end of each step at which their number may change.

    Between two rows of the result the rate stays as it is. Steps are half open: ``time`` is the end of one. Rows without a time don't count.
    """
    size, span = duration_micros(step), duration_micros(width)
    if span % size:
        raise ValueError(f"{width} is not a multiple of {step}")
    pane = F.floor(as_micros(F.col(ts)) / size).cast("bigint")
    panes = df.where(F.col(ts).isNotNull()).groupBy(*keys, pane.alias("_pane")).agg(F.count(F.lit(1)).alias("_n"))
    changes = panes.select(*keys, F.inline(F.array(
        F.struct(F.col("_pane").alias("_at"), F.col("_n").alias("_change")),
        F.struct((F.col("_pane") + span // size).alias("_at"), (-F.col("_n")).alias("_change")),
    )))
    steps = changes.groupBy(*keys, "_at").agg(F.sum("_change").alias("_change"))
    counted = running_totals(steps, keys, ("_at",), {"events": F.col("_change")}, rows_per_slice=rows_per_slice, keep=(*keys, "_at"))
    return counted.select(
        *keys, F.timestamp_micros((F.col("_at") + 1) * size).cast(df.schema[ts].dataType).alias("time"), "events",
        (F.col("events") / F.lit(duration_seconds(width))).alias("per_second"),
    )


def counter_increases(
    scrapes: DataFrame, value: str = "value", keys: Sequence[str] = (), order_by: Sequence[str] = ("ts", "event_id"),
    slices: Slices | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``increase`` and ``restarted`` to each scrape of a counter.

    The first scrape of a counter counts nothing, as it may have run for long. Scrapes without a value are left out.
    """
    known = scrapes.where(F.col(value).isNotNull())
    pairs = previous_row(known, keys, order_by, (value,), slices, rows_per_slice)
    before, now = F.col(f"prev_{value}"), F.col(value)
    fell = F.coalesce(now < before, F.lit(False))
    return pairs.withColumns({
        "increase": F.when(before.isNull(), F.lit(0)).when(fell, now).otherwise(now - before), "restarted": fell,
    }).drop(f"prev_{value}")


def counter_rate(
    scrapes: DataFrame, width: str, value: str = "value", keys: Sequence[str] = (), order_by: Sequence[str] = ("ts", "event_id"),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``keys, window_start, increase, restarts, per_second`` of a counter with restarts."""
    increases = counter_increases(scrapes, value, keys, order_by, rows_per_slice=rows_per_slice)
    return (
        increases.groupBy(*keys, F.window(order_by[0], width))
        .agg(F.sum("increase").alias("increase"), F.count_if("restarted").alias("restarts"))
        .select(*keys, F.col("window.start").alias("window_start"), "increase", "restarts",
                (F.col("increase") / F.lit(duration_seconds(width))).alias("per_second"))
    )
