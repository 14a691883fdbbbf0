"""Topic sources and sinks: option sets for Spark's Kafka connector.

The connector is a separate Spark package; these functions only set it up, so they
can be checked without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermoflow.sources.codec import decode_messages, decode_raw, decode_wire


#: Records of one micro-batch at most, so that a start over long history comes in steps.
MAX_RECORDS_PER_BATCH = 10_000_000


def source_options(topic: str, servers: str, group: str | None = None, start: str = "latest",
                   max_records_per_batch: int | None = MAX_RECORDS_PER_BATCH, fixed_group: str | None = None) -> dict[str, str]:
    """Options to read a topic. ``start`` is ``"latest"`` or ``"earliest"``.

    Spark keeps its own offsets in the checkpoint, which is what makes a restart exact.
    ``group`` is a prefix: every query gets a group id of its own below it, for the broker's
    monitoring and access rules. ``fixed_group`` sets the id itself; queries that share one
    may each get only a part of the topic, so use it for a single query only.
    ``max_records_per_batch`` bounds a micro-batch; None leaves the first start over history in one.
    """
    if start not in ("latest", "earliest"):
        raise ValueError("start must be 'latest' or 'earliest'")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group and fixed_group:
        raise ValueError("give a prefix of group ids or a fixed one, not both")
    if group:
        options["groupIdPrefix"] = group
    if fixed_group:
        options["kafka.group.id"] = fixed_group
    if max_records_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_records_per_batch)
    return options


def sink_options(topic: str, servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic(spark: SparkSession, topic: str, servers: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(topic, servers, **options)).load()


def with_arrival_id(records: DataFrame, name: str = "event_id") -> DataFrame:
    """Replace a record's partition and offset by one unique number in that order."""
    number = F.shiftleft(F.col("partition").cast("bigint"), 44) + F.col("offset")
    return records.withColumn(name, number).drop("partition", "offset")


def read_readings(spark: SparkSession, topic: str, servers: str, strict: bool = False, **options) -> DataFrame:
    """Decoded readings of a topic; their place in it is the ``event_id`` that orders equal times."""
    records = read_topic(spark, topic, servers, **options).select("key", "value", "partition", "offset")
    return decode_wire(with_arrival_id(records), strict)


def read_strings(spark: SparkSession, topic: str, servers: str, **options) -> DataFrame:
    records = read_topic(spark, topic, servers, **options)
    return records.select(F.col("value").cast("string").alias("value"))


def read_raw(spark: SparkSession, topic: str, servers: str, **options) -> DataFrame:
    return decode_raw(read_topic(spark, topic, servers, **options))


def read_messages(spark: SparkSession, topic: str, servers: str, **options) -> DataFrame:
    return decode_messages(read_topic(spark, topic, servers, **options).select("value"))


def keyed_rows(df: DataFrame, key_columns: tuple[str, ...], value: str | None = None) -> DataFrame:
    """Rows for a topic sink: a key that is the same when a batch is written again.

    The sink delivers at least once. With a key made from the result's own identity
    (window and room, say) a reader or a compacted topic can drop the repeats.
    """
    key = F.concat_ws("|", *[F.col(name).cast("string") for name in key_columns])
    body = F.col(value).cast("string") if value else F.to_json(F.struct(*df.columns))
    return df.select(key.alias("key"), body.alias("value"))


def constant_key_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that all carry the same key (they all go to one partition of the topic)."""
    return df.select(F.lit(key).alias("key"), F.col(value).cast("string").alias("value"))


def write_topic(rows: DataFrame, topic: str, servers: str, checkpoint: str, output_mode: str = "append",
                name: str | None = None):
    """Start a query that writes ``key``/``value`` rows to a topic; its name is ``topic:<topic>`` by default."""
    return (
        rows.writeStream.format("kafka").queryName(name or f"topic:{topic}").options(**sink_options(topic, servers))
        .option("checkpointLocation", checkpoint).outputMode(output_mode).start()
    )
