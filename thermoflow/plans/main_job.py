"""The main job: readings to points, for tables and for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from thermoflow.fixed_values import (
    AVERAGE_WINDOW, OUT_OF_ORDERNESS, ROOMS_AVG, ROOMS_TEMPERATURES, SOURCE_IN, SOURCE_OUT,
)
from thermoflow.functions.numeric import ratio
from thermoflow.sinks.points import store_points
from thermoflow.sources.codec import accepted
from thermoflow.streaming.event_time import with_event_time


def window_points(readings: DataFrame, width: str = AVERAGE_WINDOW, ieee: bool = False) -> DataFrame:
    """All points of the main job from one grouping: both averages and their ratio.

    A room's window gives up to three points. The readings are read, shuffled and (on a
    stream) kept in state once, not once per output.
    """
    def side(source: str):
        return F.avg(F.when(F.col("source") == source, F.col("temperature")))

    averages = (
        readings.groupBy(F.window("ts", width), "room_id")
        .agg(side(SOURCE_IN).alias("avg_in"), side(SOURCE_OUT).alias("avg_out"))
    )
    none = F.lit(None).cast("string")
    points = F.array(*[
        F.struct(F.lit(measurement).alias("measurement"), source.alias("source"), value.alias("value"))
        for measurement, source, value in (
            (ROOMS_TEMPERATURES, F.lit(SOURCE_IN), F.col("avg_in")),
            (ROOMS_TEMPERATURES, F.lit(SOURCE_OUT), F.col("avg_out")),
            (ROOMS_AVG, none, ratio(F.col("avg_in"), F.col("avg_out"), ieee)),
        )
    ])
    return (
        averages.select(F.col("window.end").alias("time"), F.col("room_id").alias("room"), F.inline(points))
        .where(F.col("value").isNotNull())
        .select("measurement", "time", "room", "source", "value")
    )


def start_main_job(
    decoded: DataFrame, path: str, checkpoint: str, delay: str = OUT_OF_ORDERNESS, width: str = AVERAGE_WINDOW,
    **trigger,
) -> StreamingQuery:
    """Decoded records of a topic to the table of points (see ``sources.kafka.read_readings``)."""
    readings = with_event_time(accepted(decoded), delay)
    return store_points(window_points(readings, width), path, checkpoint, **trigger)
