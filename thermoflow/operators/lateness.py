"""Late rows and corrections, row by row in order of arrival.

A watermark follows the newest time seen so far, some delay behind it. It says that no time up to it is still to come, in
steps of a millisecond; so a window is over when the watermark reaches its end less one step. A row that arrives when
its window is over is late. Up to an allowed lateness beyond that it still counts, as a correction of a
result that has been sent; after that it is refused.

The watermark a row meets is a running maximum over the rows that arrived before it (``ordered.running_max``), for any
number of rows and however hot a key is.

Corrections are a log: each result has a version, a correction takes the version before back (``-``) and sends a new one (``+``). A reader
that keeps the newest version per window, or one that adds and subtracts, ends with the same values as
one aggregation over all rows that were not refused. The first version counts what came in time; it stands in the log whether its window was over by the end of the
input or not. A window that only late rows fall into has its first version from the first of them.

Rows without a time belong to no window and are refused. Values that are NULL are counted as rows and add nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.fixed_values import ALLOWED_LATENESS, OUT_OF_ORDERNESS
from thermoflow.functions.time import as_micros, duration_micros
from thermoflow.operators.ordered import ROWS_PER_SLICE, Slices, running_max, running_totals

#: The steps of watermarks.
TICK = "1 millisecond"
#: How far the watermark is behind the newest time: for times that only rise, as a rule of the main job, and
#: moved on by each record.
ASCENDING, BOUNDED, PUNCTUATED = TICK, OUT_OF_ORDERNESS, "1500 milliseconds"

ON_TIME, CORRECTION, REFUSED = "on_time", "correction", "refused"


def judged_rows(
    df: DataFrame,
    width: str,
    delay: str = BOUNDED,
    lateness: str = "0 seconds",
    ts: str = "ts",
    arrival: Sequence[str] = ("arrival", "event_id"),
    keys: Sequence[str] = (),
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``watermark`` (the one a row meets, NULL at first), ``window_start, window_end`` and ``fate``.

    ``keys`` gives each of their values a watermark of its own (such as one per partition of a topic).
    """
    kind = df.schema[ts].dataType
    micros = as_micros(F.col(ts))
    met = running_max(df, keys, arrival, {"_newest": micros}, False, slices, rows_per_slice)
    mark = F.col("_newest") - F.lit(duration_micros(delay))
    over = as_micros(F.col("window_end")) - F.lit(duration_micros(TICK))
    fate = (
        F.when(F.col(ts).isNull() | (mark >= over + F.lit(duration_micros(lateness))), REFUSED)
        .when(mark >= over, CORRECTION).otherwise(ON_TIME)
    )
    # Rows without a time stay, with a window of NULL, so that they can be reported.
    start = F.floor(micros / duration_micros(width)).cast("bigint") * duration_micros(width)
    bounds = {"window_start": start, "window_end": start + F.lit(duration_micros(width))}
    return met.withColumns({
        "watermark": F.timestamp_micros(mark).cast(kind),
        **{name: F.timestamp_micros(value).cast(kind) for name, value in bounds.items()},
    }).withColumn("fate", fate).drop("_newest")


def late_rows(df: DataFrame, width: str, delay: str = BOUNDED, **options) -> DataFrame:
    """The rows that a watermark would refuse, without any allowed lateness."""
    return judged_rows(df, width, delay, "0 seconds", **options).where(F.col("fate") == REFUSED)


def correction_log(
    df: DataFrame,
    value: Column,
    width: str,
    keys: Sequence[str] = ("room_id", "source"),
    delay: str = BOUNDED,
    lateness: str = ALLOWED_LATENESS,
    arrival: Sequence[str] = ("arrival", "event_id"),
    rows_per_slice: int = ROWS_PER_SLICE,
    **options,
) -> DataFrame:
    """The changes of count and sum per key and window: ``keys, window_start, window_end, version, op, n, total``.

    Version 0 is what came in time, one aggregation. Corrections are running sums over late rows only, on top of it.
    """
    judged = judged_rows(df.withColumn("_value", value), width, delay, lateness, arrival=arrival, rows_per_slice=rows_per_slice, **options)
    groups = [*keys, "window_start", "window_end"]
    counted = judged.where(F.col("fate") == ON_TIME).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_value"), F.lit(0)).alias("total")
    )
    first = counted.select(*groups, F.lit(0).cast("bigint").alias("version"), F.lit("+").alias("op"), "n", "total")
    late = judged.where(F.col("fate") == CORRECTION).select(
        *groups, *arrival, F.coalesce("_value", F.lit(0)).alias("_value")
    )
    added = running_totals(
        late, groups, arrival, {"_n": F.lit(1), "_total": F.col("_value")}, rows_per_slice=rows_per_slice, keep=[*groups, "_value"]
    )
    # NULL keys meet, too.
    base = counted.select(F.struct(*groups).alias("_of"), F.col("n").alias("_base_n"), F.col("total").alias("_base_total"))
    based = added.withColumn("_of", F.struct(*groups)).join(base, "_of", "left")
    version = F.col("_n") - F.when(F.col("_base_n").isNull(), 1).otherwise(0)
    n, total = F.col("_n") + F.coalesce("_base_n", F.lit(0)), F.col("_total") + F.coalesce("_base_total", F.lit(0))
    change = lambda version, op, n, total: F.struct(version.alias("version"), F.lit(op).alias("op"), n.alias("n"), total.alias("total"))
    changes = F.array(change(version - 1, "-", n - 1, total - F.col("_value")), change(version, "+", n, total))
    corrections = based.select(*groups, F.inline(changes)).where("version >= 0")
    return first.unionByName(corrections)


def upserted(log: DataFrame, keys: Sequence[str] = ("room_id", "source")) -> DataFrame:
    """What a reader has that keeps the newest version: ``keys, window_start, window_end, version, n, total``."""
    newest = F.max_by(F.struct("version", "n", "total"), F.col("version")).alias("_newest")
    groups = [*keys, "window_start", "window_end"]
    return log.where("op = '+'").groupBy(*groups).agg(newest).select(*groups, "_newest.*")


def summed(log: DataFrame, keys: Sequence[str] = ("room_id", "source")) -> DataFrame:
    """What a reader has that adds new versions and subtracts those taken back, for any coarser ``keys``."""
    sign = F.when(F.col("op") == "+", 1).otherwise(-1)
    return log.groupBy(*keys).agg(F.sum(sign * F.col("n")).alias("n"), F.sum(sign * F.col("total")).alias("total"))
