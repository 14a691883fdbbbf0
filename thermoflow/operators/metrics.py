"""Measurements over data: counters, rates and value distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from thermoflow.fixed_values import HISTOGRAM_SIZE, METER_WINDOW
from thermoflow.functions.time import duration_seconds

QUANTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)


def counted(df: DataFrame, name: str | Observation, counter: str = "events") -> DataFrame:
    """Pass rows through and count them on the way.

    A batch query reads the count from an ``Observation``; a stream reports it under the
    given name in its progress.
    """
    return df.observe(name, F.count(F.lit(1)).alias(counter))


def event_count(df: DataFrame, counter: str = "events") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(counter))


def throughput(df: DataFrame, width: str = METER_WINDOW, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """Events per second in each window."""
    return (
        df.groupBy(F.window(ts, width), *keys)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            *keys, F.col("window.start").alias("window_start"), "events",
            (F.col("events") / F.lit(duration_seconds(width))).alias("per_second"),
        )
    )


def _distribution(value: str, weight: Column) -> list[Column]:
    """Figures of a whole-number field whose values come with their number of occurrences."""
    number, times = F.col(value).cast("decimal(10,0)"), weight.cast("decimal(18,0)")
    count, total, squares = F.sum(times), F.sum(number * times), F.sum(number * number * times)
    wide = "decimal(38,0)"
    # Exact sums: the result depends neither on the order of additions nor on cancellation.
    spread = count.cast(wide) * squares.cast(wide) - total.cast(wide) * total.cast(wide)
    return [
        count.cast("bigint").alias("count"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.try_divide(total.cast("double"), count.cast("double")).alias("mean"),
        F.sqrt(F.try_divide(spread.cast("double"), (count * (count - 1)).cast("double"))).alias("stddev"),
        F.percentile(value, F.array(*[F.lit(q) for q in QUANTILES]), weight).alias("_quantiles"),
    ]


def quantile_name(quantile: float) -> str:
    """0.5 is ``p50``, 0.999 is ``p99_9``."""
    return "p" + f"{quantile * 100:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def _named_quantiles() -> list[Column]:
    return [F.col("_quantiles")[i].alias(quantile_name(q)) for i, q in enumerate(QUANTILES)]


def window_histogram(
    df: DataFrame, width: str, value: str = "temperature", ts: str = "ts", keys: Sequence[str] = ()
) -> DataFrame:
    """Count, extremes, mean, deviation and quantiles of a whole-number field per window.

    Equal values are counted before anything else, so quantiles are exact and a window
    holds one entry per distinct value instead of one per row.
    """
    counts = df.groupBy(F.window(ts, width), *keys, value).agg(F.count(F.lit(1)).alias("_n"))
    out = counts.groupBy("window", *keys).agg(*_distribution(value, F.col("_n")))
    return out.select(
        F.col("window.start").alias("window_start"), *keys, "count", "min", "max", "mean", "stddev",
        *_named_quantiles(),
    )


def most_recent(
    df: DataFrame, size: int, order_by: Sequence[str] = ("ts", "event_id"), bucket: str = "1 day"
) -> DataFrame:
    """The last ``size`` rows in the given order.

    Counts per time bucket tell how far back the last rows reach; only those buckets go
    into the top-n, so old data costs one counting pass and nothing more.
    """
    ts = order_by[0]
    back = Window.orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (
        df.groupBy(F.window(ts, bucket)["start"].alias("start")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("seen", F.sum("n").over(back))
    )
    first_bucket = reached.agg(
        F.coalesce(F.max(F.when(F.col("seen") >= size, F.col("start"))), F.min("start"))
    ).scalar()
    recent = df.where(F.col(ts) >= first_bucket)
    return recent.orderBy(*[F.desc(name) for name in order_by]).limit(size)


def recent_histogram(
    df: DataFrame,
    size: int = HISTOGRAM_SIZE,
    value: str = "temperature",
    order_by: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """The same figures over the last ``size`` values: a histogram metric at the end of a run."""
    recent = most_recent(df.select(*order_by, value), size, order_by)
    counts = recent.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    out = counts.agg(*_distribution(value, F.col("_n")))
    return out.select("count", "min", "max", "mean", "stddev", *_named_quantiles())
