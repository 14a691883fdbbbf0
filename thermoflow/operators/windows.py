"""Tumbling event-time windows and their aggregates.

Means, sums and arg-max rows run on tables and on streams. Texts, value lists and
backups need the order of rows and run on tables; ``streaming.windows`` has them for
streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from thermoflow.fixed_values import AVERAGE_WINDOW
from thermoflow.functions.numeric import int_mean
from thermoflow.model import READING_ORDER
from thermoflow.operators.ordered import PART_ROWS, ROWS_PER_SLICE, Slices, ordered_parts

_BOUNDS = ("window_start", "window_end")


def _bounds(window: str = "window") -> list[Column]:
    return [F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end")]


def window_mean(
    readings: DataFrame,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = ("room_id",),
    ts: str = "ts",
    value: str = "temperature",
) -> DataFrame:
    """Mean per key and window. The window end (exclusive) is the time of the result.

    Windows without rows give nothing. One partial and one final hash aggregate, so a
    hot key reaches the shuffle as one row per window and task.
    """
    return (
        readings.groupBy(F.window(ts, width), *keys)
        .agg(F.avg(value).alias("avg_temperature"))
        .select(*keys, "avg_temperature", *_bounds())
    )


def window_sum(
    df: DataFrame,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = (),
    value: str = "temperature",
    total: str = "total",
    first_of: Sequence[str] = (),
    order_by: Sequence[str] = READING_ORDER,
    ts: str = "ts",
) -> DataFrame:
    """Sum per window, keyed or over all rows; ``first_of`` adds fields of the first row."""
    aggregates = [F.sum(value).alias(total)]
    if first_of:
        aggregates.append(F.min_by(F.struct(*first_of), F.struct(*order_by)).alias("_first"))
    out = df.groupBy(F.window(ts, width), *keys).agg(*aggregates)
    return out.select(*keys, *_bounds(), *[F.col(f"_first.{name}").alias(name) for name in first_of], total)


def window_max_row(
    df: DataFrame,
    by: str,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = (),
    tie_break: str = "event_id",
    ts: str = "ts",
) -> DataFrame:
    """The whole row with the largest ``by`` in each window; the earliest one on ties."""
    columns = [name for name in df.columns if name not in keys]
    best = F.max_by(F.struct(*columns), F.struct(F.col(by), -F.col(tie_break))).alias("_best")
    return df.groupBy(F.window(ts, width), *keys).agg(best).select(*keys, *_bounds(), "_best.*")


def _windowed(df: DataFrame, width: str, ts: str) -> DataFrame:
    return df.withColumn("window", F.window(ts, width)).withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")


def window_concat(
    df: DataFrame,
    value: Column,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = (),
    separator: str = "",
    end: str = "",
    text: str = "text",
    first_of: str | None = None,
    order_by: Sequence[str] = READING_ORDER,
    ts: str = "ts",
    part_rows: int = PART_ROWS,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """All values of a window joined to one text, in arrival order.

    A window of more than ``part_rows`` rows comes as several texts, numbered by
    ``part``; joined in that order they are the whole text. ``first_of`` adds a field of
    the first row of the window.
    """
    groups = [*keys, *_BOUNDS]
    firsts = {} if first_of is None else {"_first": F.col(first_of)}
    parts = ordered_parts(
        _windowed(df, width, ts), groups, order_by, value, part_rows, slices, rows_per_slice,
        firsts=firsts, size=F.octet_length(value),
    )
    # Parts are few: a window over them sees one row per part_rows input rows.
    from_first = Window.partitionBy(*groups).orderBy("part")
    named = [F.first("_first").over(from_first).alias(first_of)] if firsts else []
    joined = F.concat(F.array_join("items", separator), F.lit(end))
    return parts.select(*groups, "part", *named, "n", joined.alias(text))


def window_int_mean_values(
    readings: DataFrame,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = ("room_id", "source"),
    value: str = "temperature",
    order_by: Sequence[str] = READING_ORDER,
    ts: str = "ts",
    part_rows: int = PART_ROWS,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Whole-number mean of each window and the text ``"a, b, "`` of all its values.

    Long windows come in parts as in :func:`window_concat`; the mean is that of the
    whole window in each of them.
    """
    groups = [*keys, *_BOUNDS]
    parts = ordered_parts(
        _windowed(readings, width, ts), groups, order_by, F.col(value).cast("string"),
        part_rows, slices, rows_per_slice, sums={"_total": F.col(value).cast("bigint"), "_values": F.col(value).isNotNull().cast("bigint")},
    )
    whole = Window.partitionBy(*groups)
    return parts.select(
        *groups, "part",
        int_mean(F.sum("_total").over(whole), F.sum("_values").over(whole)).alias("avg_temperature"),
        F.concat(F.array_join("items", ", "), F.lit(", ")).alias("values"),
    )


def window_int_mean(
    readings: DataFrame,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = ("room_id", "source"),
    value: str = "temperature",
    ts: str = "ts",
) -> DataFrame:
    """Whole-number mean only: no values are kept, so it runs on streams too."""
    return (
        readings.groupBy(F.window(ts, width), *keys)
        .agg(int_mean(F.sum(F.col(value).cast("bigint")), F.count(value)).alias("avg_temperature"))
        .select(*keys, "avg_temperature", *_bounds())
    )


def window_backup(
    messages: DataFrame,
    width: str = AVERAGE_WINDOW,
    fields: Sequence[str] = ("sender", "recipient", "sentAt", "message"),
    order_by: Sequence[str] = READING_ORDER,
    ts: str = "ts",
    part_rows: int = PART_ROWS,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """All messages of a window as one backup record (several parts if very many)."""
    parts = ordered_parts(
        _windowed(messages, width, ts), list(_BOUNDS), order_by, F.struct(*fields),
        part_rows, slices, rows_per_slice, size=F.octet_length(F.to_json(F.struct(*fields))),
    )
    return parts.select(*_BOUNDS, "part", "n", F.col("items").alias("inputMessages"))


def stamp_backup(backups: DataFrame) -> DataFrame:
    """Add the id and wall-clock time a stored backup carries (not repeatable)."""
    return backups.withColumns({"backupTimestamp": F.current_timestamp(), "uuid": F.uuid()})
