import pytest

from thermoflow.session import shared_folder, stream_session, use_utc, working_path
from thermoflow.sinks.console import print_stream
from thermoflow.streaming.run import drained


class Cluster:
    """Just enough of a session that is not local and names no folder."""

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class conf:
        get = staticmethod(lambda name, default=None: default)


def test_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert working_path(spark, "x") != working_path(spark, "x")
    assert working_path(spark, "x").startswith(folder)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)


def test_sessions(spark):
    other = stream_session(spark, 3)
    assert other.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert use_utc(other).conf.get("spark.sql.session.timeZone") == "UTC"


def test_console_and_drain(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    query = print_stream(stream, "printed", str(tmp_path / "c"))
    query.processAllAvailable()
    query.stop()
    assert query.name == "printed"
    assert drained(spark, stream, "numbers").count() == 3
