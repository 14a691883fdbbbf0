"""Number helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from thermoflow.fixed_values import BANDS


def int_mean(total: Column, count: Column) -> Column:
    """Whole-number mean, cut towards zero; NULL where nothing was counted."""
    return F.call_function("div", total, F.nullif(count, F.lit(0)))


def ratio(numerator: Column, denominator: Column, ieee: bool = False) -> Column:
    """``numerator / denominator`` for doubles.

    A zero denominator gives NULL, or with ``ieee`` the IEEE-754 value (infinity with
    the numerator's sign, NaN for 0/0).
    """
    quotient = F.try_divide(numerator, denominator)
    if not ieee:
        return quotient
    return (
        F.when(denominator != 0, quotient)
        .when(denominator.isNull() | numerator.isNull(), F.lit(None).cast("double"))
        .when(numerator > 0, F.lit(float("inf")))
        .when(numerator < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def band(value: Column, bands: Sequence[tuple[str, float | None]] = BANDS) -> Column:
    """Name of the band a value falls in; each band starts at its lower bound."""
    chosen = F.lit(bands[0][0])
    for name, start in bands[1:]:
        chosen = F.when(value >= start, F.lit(name)).otherwise(chosen)
    return F.when(value.isNotNull(), chosen)


def room_partition(room_id: Column, partitions: int) -> Column:
    """Partition of a room: its number modulo the partition count."""
    number = F.split(room_id, "_").getItem(0).cast("int")
    return F.pmod(number, F.lit(partitions))
