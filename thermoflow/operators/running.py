"""Running aggregates: every input row gives the updated value of its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from thermoflow.functions.numeric import int_mean
from thermoflow.functions.text import split_tokens
from thermoflow.model import READING_ORDER
from thermoflow.operators.ordered import ROWS_PER_SLICE, Slices, plan_slices, running_totals


def running_mean(
    readings: DataFrame,
    keys: Sequence[str] = ("room_id", "source"),
    value: str = "temperature",
    order_by: Sequence[str] = READING_ORDER,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Whole-number mean of all values of the key so far, one row per reading; NULL values do not count."""
    totals = {"count": F.col(value).isNotNull().cast("int"), "total": F.col(value).cast("bigint")}
    columns = list(dict.fromkeys([*keys, *order_by, value]))
    running = running_totals(readings.select(*columns), keys, order_by, totals, slices, rows_per_slice,
                             keep=[*keys, *order_by])
    return running.select(*keys, *order_by, "count", "total", int_mean(F.col("total"), F.col("count")).alias("mean"))


def mean_per_key(readings: DataFrame, keys: Sequence[str] = ("room_id", "source"), value: str = "temperature") -> DataFrame:
    """The last state of :func:`running_mean`; on a stream use the ``update`` output mode."""
    return readings.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.sum(F.col(value).cast("bigint")).alias("total"),
        int_mean(F.sum(F.col(value).cast("bigint")), F.count(value)).alias("mean"),
    )


def word_count(texts: DataFrame, text: str = "text") -> DataFrame:
    """How often each word occurs; counted per task before the shuffle, so hot words are cheap."""
    words = texts.select(F.explode(split_tokens(F.col(text), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def running_word_count(
    texts: DataFrame,
    order_by: Sequence[str],
    text: str = "text",
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    span: int | str | None = None,
) -> DataFrame:
    """The count of each word so far, one row per word occurrence.

    Occurrences are ordered by the text's order columns, then by position in the text.
    Slices are spans of the first order column, cut where they hold too many words, so even
    one very long text is spread.
    """
    words = texts.select(*order_by, F.posexplode(split_tokens(F.col(text), " ")).alias("position", "word"))
    order = (*order_by, "position")
    slices = slices or plan_slices(words, order, rows_per_slice, span)
    return running_totals(words, ("word",), order, {"count": F.lit(1)}, slices, rows_per_slice)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order_by: Sequence[str],
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The sum of a field so far per key, one row per input row."""
    return running_totals(df, keys, order_by, {f"sum_{value}": F.col(value)}, slices, rows_per_slice)
