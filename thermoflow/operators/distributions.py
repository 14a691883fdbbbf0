"""Distributions of values over much data: quantile sketches kept by time, and the newest values of each key.

A sketch of a minute and key has a bounded size and can be merged with others, so a table of them answers for any range of minutes without
the rows. Ranks of its quantiles are off by ``RANK_ERROR`` at most (with a chance of 99 %; for ``SIZE`` entries), whatever is merged. Counts and
extremes are exact.

The newest values of a key are found in two steps: each share of a key's rows keeps its newest ones, by a limit that Spark applies before the
rows are shuffled, and what is left, a bounded number, is ranked again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from thermoflow.operators.metrics import QUANTILES, quantile_name

#: Entries of a sketch, and the error of ranks that goes with it.
SIZE, RANK_ERROR = 400, 0.009
#: Shares of a key's rows that are ranked apart.
SHARES = 64


def value_sketches(
    df: DataFrame, width: str = "1 minute", value: str = "temperature", ts: str = "ts", keys: Sequence[str] = (), size: int = SIZE
) -> DataFrame:
    """``keys, window_start, n, min, max, sketch`` of a whole-number field. NULL values don't count; a window of NULLs gives no row."""
    number = F.col(value).cast("bigint")
    return (
        df.where(F.col(value).isNotNull()).groupBy(*keys, F.window(ts, width))
        .agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("min"), F.max(number).alias("max"),
             F.kll_sketch_agg_bigint(number, F.lit(size)).alias("sketch"))
        .select(*keys, F.col("window.start").alias("window_start"), "n", "min", "max", "sketch")
    )


def merged_quantiles(
    sketches: DataFrame, keys: Sequence[str] = (), since: datetime | None = None, until: datetime | None = None,
    quantiles: Sequence[float] = QUANTILES, size: int = SIZE,
) -> DataFrame:
    """``keys, n, min, max`` and a column per quantile, over the sketches that start in a range of time (all, if not given)."""
    kind = sketches.schema["window_start"].dataType
    if since is not None:
        sketches = sketches.where(F.col("window_start") >= F.lit(since).cast(kind))
    if until is not None:
        sketches = sketches.where(F.col("window_start") < F.lit(until).cast(kind))
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("_all"),
    ).where(F.col("n").isNotNull())
    return merged.select(*keys, "n", "min", "max", *[
        F.kll_sketch_get_quantile_bigint("_all", F.lit(q)).alias(quantile_name(q)) for q in quantiles
    ])


def newest_per_key(
    df: DataFrame, size: int, keys: Sequence[str] = ("room_id",), order_by: Sequence[str] = ("ts", "event_id"), shares: int = SHARES
) -> DataFrame:
    """The last ``size`` rows of each key in the given order. At most ``shares * size`` rows of a key meet in one task."""
    newest: list[Column] = [F.desc(name) for name in order_by]
    # Any dealing out gives the same rows in the end.
    dealt = df.withColumn("_share", F.pmod(F.xxhash64(*order_by), F.lit(shares)))
    first = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_share").orderBy(*newest))).where(F.col("_rank") <= size)
    last = first.drop("_rank").withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return last.where(F.col("_rank") <= size).drop("_rank", "_share")
