"""Wire format of topics: JSON keys and values to columns and back.

A key is ``{"roomId": "<room>_<source>"}``, a value ``{"value": <int>, "timestamp":
<epoch ms>}``. Decoding never drops a record: one that lacks anything is kept with an
``error``, to be stored as a dead letter, or fails the query in strict mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.fixed_values import SOURCE_IN, SOURCE_OUT
from thermoflow.functions.text import split_tokens
from thermoflow.model import MESSAGE

# Largest epoch milliseconds a microsecond timestamp can hold.
_MAX_MILLIS = (2**63 - 1) // 1000


def _epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def encode_wire(readings: DataFrame, *keep: str) -> DataFrame:
    """Readings as JSON text ``key`` and ``value`` (and the columns to keep)."""
    key = F.to_json(F.struct(F.concat_ws("_", "room_id", "source").alias("roomId")))
    value = F.to_json(F.struct(F.col("temperature").alias("value"), _epoch_millis(F.col("ts")).alias("timestamp")))
    return readings.select(*keep, key.alias("key"), value.alias("value"))


def _whole_number(text: Column) -> Column:
    """Numbers as they come: 27, "27" and 27.9 are all 27."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def decode_wire(
    records: DataFrame, strict: bool = False, sources: Sequence[str] | None = (SOURCE_IN, SOURCE_OUT)
) -> DataFrame:
    """Records (``key``, ``value``, …) as readings with an ``error`` that is NULL if all is well.

    Only the named ``sources`` are accepted; None accepts any.
    """
    others = [name for name in records.columns if name not in ("key", "value")]
    texts = records.select(
        *others, F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )
    # Parsed by generators: filters on the outcome stay above them, where parsing in a
    # projection would be repeated for every use of its result.
    parsed = texts.select("*", F.json_tuple("key", "roomId").alias("_id"))
    parsed = parsed.select("*", F.json_tuple("value", "value", "timestamp").alias("_value", "_millis"))
    parsed = parsed.withColumn("_room", split_tokens(F.col("_id"), "_"))
    millis = _whole_number(F.col("_millis"))
    decoded = parsed.select(
        *others, "key", "value",
        F.get("_room", F.lit(0)).alias("room_id"),
        F.get("_room", F.lit(1)).alias("source"),
        F.timestamp_millis(F.when(millis.between(-_MAX_MILLIS, _MAX_MILLIS), millis)).alias("ts"),
        _whole_number(F.col("_value")).try_cast("int").alias("temperature"),
    ).withColumn(
        "error",
        F.when(F.col("room_id").isNull(), "no room")
        .when(F.col("source").isNull(), "no source")
        .when(~F.col("source").isin(*sources) if sources is not None else F.lit(False), "unknown source")
        .when(F.col("ts").isNull(), "no timestamp")
        .when(F.col("temperature").isNull(), "no temperature"),
    )
    if strict:
        message = F.concat_ws(" ", F.lit("cannot decode:"), F.col("error"), F.lit("in"), F.col("key"), F.col("value"))
        decoded = decoded.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(message).cast("string")))
    return decoded


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error").isNull()).drop("key", "value", "error")


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error").isNotNull()).select("key", "value", "error")


def decode_raw(records: DataFrame) -> DataFrame:
    """Key and value as text and the record's own time, nothing parsed."""
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def encode_messages(messages: DataFrame, *keep: str) -> DataFrame:
    return messages.select(*keep, F.to_json(F.struct("sender", "recipient", "sentAt", "message")).alias("value"))


def decode_messages(records: DataFrame, strict: bool = False) -> DataFrame:
    """JSON messages as columns; broken ones become all NULL, or fail in strict mode."""
    others = [name for name in records.columns if name != "value"]
    options = {"mode": "FAILFAST"} if strict else {}
    text = F.col("value").cast("string")
    return records.select(*others, F.from_json(text, MESSAGE, options).alias("_m")).select(*others, "_m.*")


def event_time(messages: DataFrame, column: str = "sentAt", unit: str = "milliseconds") -> DataFrame:
    """Add ``ts`` from an epoch number in ``"milliseconds"`` or ``"seconds"``."""
    convert = {"milliseconds": F.timestamp_millis, "seconds": F.timestamp_seconds}[unit]
    return messages.withColumn("ts", convert(F.col(column)))


def encode_json(df: DataFrame, columns: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Each row (or the given columns of it) as one JSON text ``value``."""
    return df.select(*keep, F.to_json(F.struct(*(columns or df.columns))).alias("value"))
