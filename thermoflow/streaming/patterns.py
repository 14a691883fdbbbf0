"""Warnings and alerts on streams, with the same results as on tables.

The stream is cut into short tumbling slices of event time. A slice, once closed, gives
the neighbouring pairs inside it and its first and last row; a second grouping chains
last to first rows of neighbouring slices. State per key is one slice of rows plus one
pair of edge rows per slice, so a busy room is spread over as many groups as there are
slices, and each reading belongs to exactly one slice: a late reading that its slice
refuses is not seen by any neighbour either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.fixed_values import ALERT_GAP, WARNING_GAP, WARNING_THRESHOLD
from thermoflow.functions.time import duration_micros, interval
from thermoflow.model import READING_ORDER
from thermoflow.operators.patterns import SCOPE_KEYS, pair_to_alert, pair_to_warning


def _neighbours(items: str, pair) -> Column:
    """Combine each item of a sorted array with the one before it."""
    count = F.size(items) - 1
    return F.zip_with(F.slice(items, F.lit(1), count), F.slice(items, F.lit(2), count), pair)


def stream_pairs(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    fields: Sequence[str],
    within: str,
    slice_width: str = "1 second",
) -> DataFrame:
    """Rows with ``prev_<field>`` for neighbours per key that are closer than ``within``.

    Needs a watermark on the first order column. Pairs further apart may be missing:
    they are outside the reach of the chaining windows.
    """
    ts = order_by[0]
    columns = list(dict.fromkeys([*order_by, *fields]))
    payload = [name for name in columns if name not in keys]

    def pair(previous: Column, row: Column) -> Column:
        return F.struct(
            *[row[name].alias(name) for name in payload],
            *[previous[name].alias(f"prev_{name}") for name in fields],
        )

    def chain(before: Column, edge: Column) -> Column:
        return F.struct(edge["closed"].alias("closed"), pair(before["last"], edge["first"]).alias("pair"))

    items = F.sort_array(F.collect_list(F.struct(*columns)))
    slices = (
        df.groupBy(F.window(ts, slice_width).alias("slice"), *keys)
        .agg(items.alias("rows"))
        .withColumn("closed", F.window_time("slice"))
    )
    inside = slices.select(*keys, F.explode(_neighbours("rows", pair)).alias("pair"))

    step = duration_micros(within) + duration_micros(slice_width)
    edge = F.struct("closed", F.element_at("rows", 1).alias("first"), F.element_at("rows", -1).alias("last"))
    chained = (
        slices.select(*keys, "closed", edge.alias("edge"))
        .groupBy(F.window("closed", f"{2 * step} microseconds", f"{step} microseconds"), *keys)
        .agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    )
    across = chained.select(
        *keys, F.col("window.end").alias("until"),
        F.inline(_neighbours("edges", chain)),
    ).where(F.col("closed") >= F.col("until") - interval(f"{step} microseconds"))

    out = [*payload, *[f"prev_{name}" for name in fields]]
    return (
        inside.select(*keys, *[F.col(f"pair.{name}").alias(name) for name in out])
        .unionByName(across.select(*keys, *[F.col(f"pair.{name}").alias(name) for name in out]))
    )


def stream_warnings(
    readings: DataFrame,
    threshold: int = WARNING_THRESHOLD,
    within: str = WARNING_GAP,
    exact: bool = False,
    slice_width: str = "1 second",
) -> DataFrame:
    """Warnings of a stream of readings with a watermark on ``ts`` (append mode)."""
    pairs = stream_pairs(
        readings, ("room_id", "source"), READING_ORDER, ("ts", "temperature"), within, slice_width
    )
    return pair_to_warning(pairs, threshold, within, exact)


def warning_delay(within: str = WARNING_GAP, slice_width: str = "1 second") -> str:
    """How far behind the newest stored warning a further one may still come.

    A pair across slices waits for its chain to close, one step after its slice at most,
    while later pairs inside slices are out already. This holds from one stored batch to
    the next, so the table of warnings must be read in whole batches: do not limit the
    files per trigger.
    """
    step = duration_micros(within) + duration_micros(slice_width)
    return f"{step + duration_micros(slice_width)} microseconds"


def stream_alerts(
    warned: DataFrame, within: str = ALERT_GAP, scope: str = "global", slice_width: str = "1 second"
) -> DataFrame:
    """Alerts of a stream of stored warnings with a watermark of at least :func:`warning_delay`."""
    pairs = stream_pairs(
        warned, SCOPE_KEYS[scope], READING_ORDER, ("ts", "room_id", "avg_temperature"), within, slice_width
    )
    return pair_to_alert(pairs, within)
