"""Session settings and the shared folder for checkpoints and working tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "thermoflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library relies on; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch conversions and NTZ casts agree with plain SQL only in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application with settings for stateful streams.

    The number of state partitions is fixed when a stream first starts and is not
    adapted later, and every partition commits a state store in every micro-batch. So it
    should follow the cores there are (the default) or the rate of the stream, not the
    number of partitions that suits batch shuffles.
    """
    session = spark.newSession()
    for name, value in SETTINGS.items():
        session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", partitions or spark.sparkContext.defaultParallelism)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a
    folder would differ from machine to machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="thermoflow-"))
    return context.getCheckpointDir()


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
