"""Sensor readings, records and messages taken from the generic tables of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermoflow.fixed_values import SOURCE_IN, SOURCE_OUT
from thermoflow.functions.time import as_micros

ROOMS = 5
IN_EVENTS = ("view", "click")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files, whether it is one file or a folder of them.

    The stream source takes folders: the table's own, or the one above, filtered by name.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile():
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return stream.parquet(path)


def readings_from_events(events: DataFrame, source: str | None = None) -> DataFrame:
    """Each event as a reading: a room per user group, a source per kind of event.

    With ``source`` only that side is read, as a filter on the stored column that
    reaches the scan.
    """
    inside = F.col("event_type").isin(*IN_EVENTS)
    if source == SOURCE_IN:
        events = events.where(inside)
    elif source == SOURCE_OUT:
        events = events.where(~inside)
    return events.select(
        F.pmod("user_id", F.lit(ROOMS)).cast("string").alias("room_id"),
        F.when(inside, SOURCE_IN).otherwise(SOURCE_OUT).alias("source"),
        "ts",
        F.floor("value").cast("int").alias("temperature"),
        "event_id",
    )


def arrivals(readings: DataFrame, speed: int = 60, disorder_ms: int = 10_000) -> DataFrame:
    """The readings as they may reach a consumer: times run faster, and each row arrives up to ``disorder_ms`` after its time."""
    micros = F.call_function("div", as_micros(F.col("ts")), F.lit(speed))
    kind = readings.schema["ts"].dataType
    late = F.pmod(F.col("event_id") * 7919, F.lit(disorder_ms)) * 1000
    return readings.withColumns({
        "ts": F.timestamp_micros(micros).cast(kind), "arrival": F.timestamp_micros(micros + late).cast(kind),
    })


def compound_id(readings: DataFrame) -> Column:
    return F.concat(F.lit("room_"), F.col("room_id"), F.lit("_"), F.col("source"))


def messages_from_conversations(conversations: DataFrame) -> DataFrame:
    """Each turn as a message; a conversation starts per minute, a turn per second."""
    sent = F.col("conv_id") * 60_000 + F.col("turn") * 1000
    return conversations.select(
        F.col("role").alias("sender"),
        F.when(F.col("role") == "user", "assistant").otherwise("user").alias("recipient"),
        sent.alias("sentAt"),
        F.col("text").alias("message"),
        F.timestamp_millis(sent).cast("timestamp_ntz").alias("ts"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("event_id"),
    )
