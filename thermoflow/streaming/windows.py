"""Order-dependent window results on streams.

Sums, means and arg-max rows need no code of their own: the functions of
``operators.windows`` run on streams as they are. Joined texts and backups of a window
would keep all its rows in one state entry; here the window is cut into slices of event
time, each giving one numbered part as soon as it is closed.

``store_closed_windows`` goes further: state entries hold a bounded number of rows each, by blocks of the rows' unique ids, and the rows of windows that
a batch closes are handed to the functions for tables. So parts are numbered as in tables, and
a hot window is spread in the state as well as in the work.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from thermoflow.fixed_values import AVERAGE_WINDOW
from thermoflow.functions.time import duration_micros
from thermoflow.model import READING_ORDER
from thermoflow.sinks.commits import CommittedTable
from thermoflow.sinks.points import FILE_INTERVAL


def stream_parts(
    df: DataFrame,
    value: Column,
    width: str = AVERAGE_WINDOW,
    keys: Sequence[str] = (),
    slice_width: str = "1 second",
    order_by: Sequence[str] = READING_ORDER,
) -> DataFrame:
    """The values of each window in order: ``keys, window_start, window_end, part, n, items``.

    ``part`` is the number of the slice within the window, counting empty slices. A slice
    as wide as the window makes it one part 0.
    """
    step, whole = duration_micros(slice_width), duration_micros(width)
    if whole % step:
        raise ValueError(f"{width} is not a multiple of {slice_width}")
    items = F.sort_array(F.collect_list(F.struct(*order_by, value.alias("_value"))))
    parts = df.groupBy(F.window(order_by[0], slice_width), *keys).agg(
        F.count(F.lit(1)).alias("n"), items.alias("items")
    )
    start = F.unix_micros("window.start")
    window_start = F.floor(start / whole).cast("bigint") * F.lit(whole)
    return parts.select(
        *keys,
        F.timestamp_micros(window_start).alias("window_start"),
        F.timestamp_micros(window_start + F.lit(whole)).alias("window_end"),
        F.call_function("div", start - window_start, F.lit(step)).alias("part"),
        "n",
        F.transform("items", lambda item: item["_value"]).alias("items"),
    )


def stream_concat(
    df: DataFrame, value: Column, width: str = AVERAGE_WINDOW, keys: Sequence[str] = (), separator: str = "",
    slice_width: str = "1 second", text: str = "text", order_by: Sequence[str] = READING_ORDER,
) -> DataFrame:
    """The values of each window joined to texts, one per part."""
    parts = stream_parts(df, value, width, keys, slice_width, order_by)
    return parts.withColumn(text, F.array_join("items", separator)).drop("items")


def stream_backup(
    messages: DataFrame, width: str = AVERAGE_WINDOW,
    fields: Sequence[str] = ("sender", "recipient", "sentAt", "message"),
    slice_width: str = "1 second", order_by: Sequence[str] = READING_ORDER,
) -> DataFrame:
    """The messages of each window as backup records, one per part."""
    parts = stream_parts(messages, F.struct(*fields), width, (), slice_width, order_by)
    return parts.withColumnRenamed("items", "inputMessages")


STATE_ROWS = 1000


def closed_rows(df: DataFrame, width: str = AVERAGE_WINDOW, ts: str = "ts", unique_id: str = "event_id", state_rows: int = STATE_ROWS) -> DataFrame:
    """The rows of windows that are closed, as they were (append mode; needs a watermark). All rows of a window come in one batch.

    A state entry has the rows of a window whose ids lie in one block of ``state_rows`` numbers, so at most that many.
    """
    block = F.floor(F.col(unique_id) / state_rows)
    held = df.groupBy(F.window(ts, width), block.alias("_block")).agg(F.collect_list(F.struct(*df.columns)).alias("_rows"))
    return held.select(F.inline("_rows"))


def store_closed_windows(
    df: DataFrame, results: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, stream: str, width: str = AVERAGE_WINDOW,
    ts: str = "ts", unique_id: str = "event_id", state_rows: int = STATE_ROWS, **trigger,
) -> StreamingQuery:
    """Store what ``results``, a function for tables, makes of the rows of closed windows; each window once.

    ``results`` must work window by window, such as ``window_concat`` or ``window_backup`` of the same width.
    """
    rows = closed_rows(df, width, ts, unique_id, state_rows)

    def write(batch: DataFrame, number: int) -> None:
        CommittedTable(batch.sparkSession, path).append(results(batch), stream, number)

    return (
        rows.writeStream.foreachBatch(write).queryName(stream).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FILE_INTERVAL})).start()
    )
