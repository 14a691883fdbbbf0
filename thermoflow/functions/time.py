"""Event-time helpers that work on TIMESTAMP and TIMESTAMP_NTZ alike (session in UTC)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_UNITS = {
    "microsecond": 1e-6, "millisecond": 1e-3, "second": 1.0,
    "minute": 60.0, "hour": 3600.0, "day": 86400.0,
}


def duration_seconds(duration: str) -> float:
    """Seconds in a duration such as ``"5 seconds"`` or ``"1 hour 30 minutes"``."""
    pieces = re.findall(r"(\d+)\s+([a-z]+?)s?\b", duration.lower())
    if not pieces or any(unit not in _UNITS for _, unit in pieces):
        raise ValueError(f"not a duration: {duration!r}")
    return sum(int(count) * _UNITS[unit] for count, unit in pieces)


def duration_micros(duration: str) -> int:
    return round(duration_seconds(duration) * 1_000_000)


def as_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def closer_than(earlier: Column, later: Column, duration: str) -> Column:
    """``later - earlier < duration``, strictly."""
    return as_micros(later) - as_micros(earlier) < F.lit(duration_micros(duration))


def interval(duration: str) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {duration_micros(duration)} / 1000000BD)")
