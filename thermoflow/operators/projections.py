"""Filters, projections and token generators over readings and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.fixed_values import FILTER_THRESHOLD
from thermoflow.functions.text import parts_of, split_tokens


def only_source(readings: DataFrame, source: str) -> DataFrame:
    return readings.where(F.col("source") == source)


def at_least(readings: DataFrame, threshold: float = FILTER_THRESHOLD, value: str = "temperature") -> DataFrame:
    return readings.where(F.col(value) >= threshold)


def non_empty(records: DataFrame, value: str = "value") -> DataFrame:
    return records.where(F.col(value).isNotNull() & (F.col(value) != ""))


def ids(readings: DataFrame, id_column: str = "id") -> DataFrame:
    return readings.select(id_column)


def upper_case(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(column))


def tokens(df: DataFrame, text: str, separator: str, token: str = "token") -> DataFrame:
    """One row per token of the text, beside the other columns."""
    others = [name for name in df.columns if name != text]
    return df.select(*others, F.explode(split_tokens(F.col(text), separator)).alias(token))


def words_with_one(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, 1)`` for every word of the text."""
    return df.select(F.explode(split_tokens(F.col(text), " ")).alias("word"), F.lit(1).alias("one"))


def split_compound_id(df: DataFrame, compound: str = "id") -> DataFrame:
    """``room_<n>_<source>`` becomes the two columns ``room`` and ``source``."""
    room, source = parts_of(F.col(compound))
    return df.withColumns({"room": room, "source": source}).drop(compound)


def text_length(value: Column) -> Column:
    return F.length(value).cast("string")
