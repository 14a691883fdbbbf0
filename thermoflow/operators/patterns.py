"""Two-stage pattern: hot neighbours make a warning, rising neighbours an alert.

Contract:

* Readings are ordered by event time per room and source; a unique id decides ties.
* A warning needs two *adjacent* readings, both at or above the threshold. Any reading
  in between, however cold, breaks the pair; so the predecessor is taken before the
  threshold is applied.
* Pairs may overlap: 31, 32, 33 make the pairs (31, 32) and (32, 33).
* ``within`` is strict: the second reading comes less than that after the first.
* A warning has the time of its second reading, an alert that of its second warning.
* An alert needs two adjacent warnings with a rising mean. It carries the room of the
  first and the mean of the second warning. In the scope ``"global"`` neighbours may
  belong to different rooms, in the scope ``"room"`` they may not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from thermoflow.fixed_values import ALERT_GAP, SOURCE_IN, SOURCE_OUT, WARNING_GAP, WARNING_THRESHOLD
from thermoflow.functions.numeric import int_mean
from thermoflow.functions.time import closer_than
from thermoflow.model import READING_ORDER
from thermoflow.operators.ordered import ROWS_PER_SLICE, Slices, previous_row
from thermoflow.operators.projections import only_source

SCOPE_KEYS = {"global": ("source",), "room": ("room_id", "source")}


def pair_to_warning(pairs: DataFrame, threshold: int, within: str, exact: bool = False) -> DataFrame:
    """Keep the pairs (``prev_*``, row) that make a warning."""
    # As BIGINT: two INT values may add up to more than an INT holds.
    both = F.col("prev_temperature").cast("bigint") + F.col("temperature").cast("bigint")
    mean = both / 2 if exact else int_mean(both, F.lit(2)).cast("double")
    return pairs.where(
        (F.col("temperature") >= threshold)
        & (F.col("prev_temperature") >= threshold)
        & closer_than(F.col("prev_ts"), F.col("ts"), within)
    ).select("room_id", "source", "ts", "event_id", mean.alias("avg_temperature"))


def pair_to_alert(pairs: DataFrame, within: str) -> DataFrame:
    """Keep the pairs of warnings that make an alert."""
    return pairs.where(
        (F.col("prev_avg_temperature") < F.col("avg_temperature"))
        & closer_than(F.col("prev_ts"), F.col("ts"), within)
    ).select(
        F.col("prev_room_id").alias("room_id"), "source", "ts", "event_id",
        F.col("avg_temperature").alias("alerted_temperature"),
    )


def warnings(
    readings: DataFrame,
    threshold: int = WARNING_THRESHOLD,
    within: str = WARNING_GAP,
    exact: bool = False,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Warnings of all rooms and sources. ``exact`` keeps the half degree of the mean."""
    pairs = previous_row(
        readings.select("room_id", "source", "ts", "event_id", "temperature"),
        ("room_id", "source"), READING_ORDER, ("ts", "temperature"), slices, rows_per_slice,
    )
    return pair_to_warning(pairs, threshold, within, exact)


def alerts(
    warned: DataFrame,
    within: str = ALERT_GAP,
    scope: str = "global",
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Alerts from warnings. The slices of the readings may be passed on to save a pass."""
    pairs = previous_row(
        warned, SCOPE_KEYS[scope], READING_ORDER, ("ts", "room_id", "avg_temperature"),
        slices, rows_per_slice,
    )
    return pair_to_alert(pairs, within)


def compat_alerts(alerted: DataFrame) -> DataFrame:
    """The historic outcome for OUT: a copy of the alerts of IN under the source OUT."""
    return only_source(alerted, SOURCE_IN).withColumn("source", F.lit(SOURCE_OUT))
