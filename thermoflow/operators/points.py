"""Results as points of a time-series store: measurement, time, tags and a field."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from thermoflow.fixed_values import NEW_ROOMS, ROOMS_AVG, ROOMS_TEMPERATURES
from thermoflow.functions.encoding import line_protocol


def relation_points(relations: DataFrame, measurement: str = ROOMS_AVG) -> DataFrame:
    return relations.select(
        F.lit(measurement).alias("measurement"), F.col("window_end").alias("time"),
        F.col("room_id").alias("room"), F.col("relation").alias("value"),
    )


def temperature_points(averages: DataFrame, measurement: str = ROOMS_TEMPERATURES) -> DataFrame:
    """Points of window averages that carry their source (IN and OUT in one table)."""
    return averages.select(
        F.lit(measurement).alias("measurement"), F.col("window_end").alias("time"),
        F.col("room_id").alias("room"), "source", F.col("avg_temperature").alias("value"),
    )


def reading_points(readings: DataFrame, measurement: str = NEW_ROOMS) -> DataFrame:
    """Points of single readings, with the whole-number field ``temp``."""
    return readings.select(
        F.lit(measurement).alias("measurement"), F.col("ts").alias("time"),
        F.col("room_id").alias("room"), "source", F.col("temperature").alias("temp"),
    )


def as_lines(points: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """One line-protocol text per point; rows whose fields are all NULL have none."""
    if fields is None:
        fields = {"value": "double"} if "value" in points.columns else {"temp": "int"}
    tags = {name: F.col(name) for name in ("room", "source") if name in points.columns}
    line = line_protocol(
        F.col("measurement"), tags, {name: (F.col(name), kind) for name, kind in fields.items()}, F.col("time")
    )
    return points.select(line.alias("line")).where(F.col("line").isNotNull())
