"""Event time and watermarks of streams.

Rows whose window has closed are dropped and counted in the query progress
(``numRowsDroppedByWatermark``); there is no side output. Spark moves the watermark
once per micro-batch, and a row still counts in the very batch that closes its window.
So how late a row may be depends on the trigger too, but every row counts wholly or not
at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from thermoflow.fixed_values import ALLOWED_LATENESS, OUT_OF_ORDERNESS
from thermoflow.functions.time import duration_micros


def with_event_time(df: DataFrame, delay: str = OUT_OF_ORDERNESS, ts: str = "ts") -> DataFrame:
    """Set the watermark of a stream (times up to ``delay`` out of order); batches pass unchanged.

    Watermarks need TIMESTAMP, so TIMESTAMP_NTZ columns are converted (session in UTC).
    """
    if not df.isStreaming:
        return df
    return df.withColumn(ts, df[ts].cast("timestamp")).withWatermark(ts, delay)


def ascending(df: DataFrame, ts: str = "ts") -> DataFrame:
    """For times that only rise: no allowance for disorder."""
    return with_event_time(df, "0 seconds", ts)


def punctuated(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The watermark stays 1.5 seconds behind the newest row."""
    return with_event_time(df, "1500 milliseconds", ts)


def with_lateness(
    df: DataFrame, delay: str = "0 seconds", lateness: str = ALLOWED_LATENESS, ts: str = "ts"
) -> DataFrame:
    """Keep windows open for late rows: disorder and lateness add up to one delay.

    In append mode a window then gives one final row that includes the late ones; in
    update mode it gives a new row whenever a late one arrives.
    """
    total = duration_micros(delay) + duration_micros(lateness)
    return with_event_time(df, f"{total} microseconds", ts)
