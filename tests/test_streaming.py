"""Streams against the same functions on tables, late rows, and the running jobs."""

import random
import time

import pytest
from conftest import at, rows, same_rows
from pyspark.sql import functions as F

from thermoflow.model import READING
from thermoflow.operators import windows
from thermoflow.operators.metrics import counted
from thermoflow.operators.patterns import alerts, warnings
from thermoflow.operators.relation import int_relation, relation, relation_by_join
from thermoflow.operators.running import mean_per_key
from thermoflow.plans.alerting import Alerting
from thermoflow.plans.main_job import start_main_job, window_points
from thermoflow.session import stream_session, working_path
from thermoflow.sinks.points import read_points, store_batches
from thermoflow.sources import codec
from thermoflow.streaming.event_time import ascending, punctuated, with_event_time, with_lateness
from thermoflow.streaming.patterns import stream_alerts, stream_warnings, warning_delay
from thermoflow.streaming.progress import CounterListener
from thermoflow.streaming.run import drain
from thermoflow.streaming.windows import stream_backup, stream_concat


@pytest.fixture
def feed(spark, tmp_path):
    """Stored batches of rows as a stream that takes one batch at a time."""
    session = stream_session(spark, 2)

    def make(*batches, schema=READING):
        folder = tmp_path / "feed"
        for i, batch in enumerate(batches):
            spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(folder / f"{i:03d}"))
        return session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")

    return make


@pytest.fixture
def result(spark, tmp_path):
    counter = iter(range(100))

    def run(df, mode="append"):
        name = str(tmp_path / f"out{next(counter)}")
        drain(df, name, f"{name}-checkpoint", mode)
        return spark.read.schema(df.schema).parquet(name)

    return run


def random_batches(seed, n=200, batches=2, disorder=2.0):
    """Readings out of order by less than the disorder; the last one, far in the future, closes all windows."""
    rng = random.Random(seed)
    second, data = 0.0, []
    for i in range(n):
        second += rng.choice([0.1, 0.3, 0.5, 2, 5])
        data.append((str(rng.choice([0, 0, 1, 2])), rng.choice(["IN", "OUT"]), at(second), rng.randrange(27, 40), i))
    data.sort(key=lambda r: (r[2].timestamp() + rng.random() * disorder))
    size = n // batches + 1
    parts = [data[i:i + size] for i in range(0, n, size)]
    parts[-1] = [*parts[-1], ("9", "IN", at(1e6), 0, n)]
    return data, parts


@pytest.fixture
def table_of(spark):
    return lambda data: spark.createDataFrame(data, READING)


def test_relations_equal_the_tables(feed, result, table_of):
    data, batches = random_batches(1)
    stream, table = with_event_time(feed(*batches)), table_of(data)
    for form in (relation, relation_by_join, int_relation):
        same_rows(result(form(stream)), form(table))
    same_rows(result(window_points(stream)), window_points(table))


def test_window_aggregates_equal_the_tables(feed, result, table_of):
    data, batches = random_batches(2)
    stream, table = with_event_time(feed(*batches)), table_of(data)
    same_rows(result(windows.window_sum(stream, keys=("room_id",))), windows.window_sum(table, keys=("room_id",)))
    same_rows(result(windows.window_sum(stream, first_of=("room_id",))), windows.window_sum(table, first_of=("room_id",)))
    same_rows(result(windows.window_max_row(stream, "temperature")), windows.window_max_row(table, "temperature"))
    same_rows(result(windows.window_int_mean(stream)), windows.window_int_mean(table))
    value = F.col("temperature").cast("string")
    whole = windows.window_concat(table, value, "10 seconds", ("room_id",))
    same_rows(result(stream_concat(stream, value, "10 seconds", ("room_id",), slice_width="10 seconds")), whole)
    parts = result(stream_concat(stream, value, "10 seconds", ("room_id",)))
    assert parts.where("part > 0").count() > 0
    joined = parts.groupBy("room_id", "window_start", "window_end").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "").alias("text")
    )
    same_rows(joined, whole.select("room_id", "window_start", "window_end", "text"))
    messages = table.select("*", F.col("room_id").alias("sender"))
    streamed = stream.select("*", F.col("room_id").alias("sender"))
    fields = ("sender", "temperature")
    same_rows(result(stream_backup(streamed, fields=fields, slice_width="5 seconds")), windows.window_backup(messages, fields=fields))


@pytest.mark.parametrize("slice_width, scope", [("1 second", "global"), ("7 seconds", "room")])
def test_patterns_equal_the_tables(spark, feed, result, table_of, slice_width, scope):
    data, batches = random_batches(3)
    found = result(stream_warnings(with_event_time(feed(*batches)), slice_width=slice_width))
    expected = warnings(table_of(data))
    assert expected.count() > 20
    same_rows(found, expected)

    # The stored warnings as a stream of their own, closed by a late one.
    schema, folder = expected.schema, working_path(spark, "warnings")
    closing = spark.createDataFrame([("9", "IN", at(1e6), 10**6, 0.0)], schema)
    expected.unionByName(closing).write.parquet(folder)
    warned = with_event_time(
        stream_session(spark, 2).readStream.schema(schema).parquet(folder), warning_delay(slice_width=slice_width)
    )
    same_rows(result(stream_alerts(warned, scope=scope, slice_width=slice_width)), alerts(expected, scope=scope))


def test_late_rows(feed, result):
    """Watermark 3 s: a row 2.5 s late still counts, one behind a closed window is dropped."""
    batches = [
        [("0", "IN", at(4), 20, 0), ("0", "IN", at(7), 30, 1)],
        [("0", "IN", at(4.5), 40, 2), ("0", "IN", at(9), 50, 3)],
        [("0", "IN", at(9.1), 40, 4)],
        [("0", "IN", at(1), 99, 5), ("0", "IN", at(20), 1, 6)],
    ]
    out = result(windows.window_mean(with_event_time(feed(*batches), "3 seconds")))
    assert rows(out, "window_end", "avg_temperature") == [(at(5), 30.0), (at(10), 40.0)]


def test_lateness_keeps_windows_open(feed, result):
    seconds = [(1, 20), (5.4, 30), (5.45, 30), (2, 40), (30, 1)]
    batches = [[("0", "IN", at(second), value, i)] for i, (second, value) in enumerate(seconds)]
    stream = feed(*batches)
    late = result(windows.window_mean(with_lateness(stream)))
    assert rows(late, "window_end", "avg_temperature") == [(at(5), 30.0), (at(10), 30.0)]
    strict = result(windows.window_mean(ascending(stream)))
    assert rows(strict, "window_end", "avg_temperature") == [(at(5), 20.0), (at(10), 30.0)]
    assert rows(result(windows.window_mean(punctuated(stream))), "window_end") == [(at(5),), (at(10),)]


def test_a_late_reading_is_refused_everywhere(feed, result):
    """A reading whose slice is closed neither makes nor breaks a pair of the next slice."""
    batches = [
        [("0", "IN", at(0.9), 31, 0), ("0", "IN", at(6), 0, 1)],
        [("1", "IN", at(6), 0, 2)],
        [("0", "IN", at(0.95), 5, 3), ("0", "IN", at(4.2), 33, 4), ("0", "IN", at(1e6), 0, 5)],
    ]
    found = result(stream_warnings(with_event_time(feed(*batches), "3 seconds")))
    assert rows(found, "ts", "avg_temperature") == [(at(4.2), 32.0)]


def test_batches_pass_unchanged(readings):
    df = readings([("0", "IN", 0, 1)])
    assert with_event_time(df) is df


def test_update_mode(spark, feed, tmp_path):
    stream = feed([("0", "IN", at(0), 3, 0)], [("0", "IN", at(1), 4, 1), ("1", "IN", at(1), 9, 2)])
    path = str(tmp_path / "updates")
    store_batches(mean_per_key(stream), path, f"{path}-c", "update", availableNow=True).awaitTermination()
    updates = spark.read.parquet(path)
    assert rows(updates, "batch_id", "room_id", "count", "mean") == [(0, "0", 1, 3), (1, "0", 2, 3), (1, "1", 1, 9)]


def test_main_job(spark, feed, tmp_path, table_of):
    data, batches = random_batches(4)
    schema = "key string, value string, event_id bigint"
    wire = [[tuple(r) for r in codec.encode_wire(table_of(b), "event_id").select("key", "value", "event_id").collect()] for b in batches]
    wire[0].append(("broken", "{", -1))
    decoded = codec.decode_wire(feed(*wire, schema=schema))
    path = str(tmp_path / "points")
    start_main_job(decoded, path, f"{path}-c", availableNow=True).awaitTermination()
    # The wire keeps milliseconds, as do the times of these readings.
    same_rows(read_points(spark, path), window_points(table_of(data)))


def test_alerting_jobs(spark, tmp_path, table_of):
    """Both jobs, stopped and started again after every batch of readings."""
    data, batches = random_batches(5, n=240, batches=3)
    end = 1e6
    # A warning that closes all alerts, and a reading that lets it out.
    batches[-1][-1:] = [("9", "IN", at(end), 35, 1000), ("9", "IN", at(end + 1), 35, 1001), ("9", "IN", at(2 * end), 0, 1002)]
    job = Alerting(slice_width="2 seconds")
    source, found, alerted = (str(tmp_path / name) for name in ("readings", "warnings", "alerts"))
    observed = 0
    for batch in batches:
        table_of(batch).coalesce(1).write.mode("append").parquet(source)
        session = stream_session(spark, 2)
        readings = session.readStream.schema(READING).parquet(source)
        job.start_warnings(readings, found, f"{found}-c", availableNow=True).awaitTermination()
        query = job.start_alerts(session, found, alerted, f"{alerted}-c", availableNow=True)
        query.awaitTermination()
        observed += sum(p.observedMetrics["alerting"].alerts for p in query.recentProgress if p.observedMetrics)

    tables = job.tables(spark, table_of(data), rows_per_slice=50)
    same_rows(tables["warnings"], warnings(table_of(data)))
    same_rows(spark.read.parquet(found).where("event_id < 1000"), tables["warnings"])
    same_rows(tables["alerts"], alerts(warnings(table_of(data))))
    assert tables["alerts"].count() > 5
    same_rows(spark.read.parquet(alerted), tables["alerts"])
    assert observed == tables["alert_counts"].agg(F.sum("alerts")).first()[0] == tables["alerts"].count()


def test_counters(spark, feed, result):
    listener = CounterListener()
    stream = counted(feed([("0", "IN", at(0), 3, 0)], [("0", "IN", at(1), 4, 1), ("1", "IN", at(1), 9, 2)]), "seen")
    session = stream.sparkSession
    session.streams.addListener(listener)
    result(stream.select("room_id"))
    deadline = time.monotonic() + 20
    while listener.counts["events"] < 3 and time.monotonic() < deadline:
        time.sleep(0.1)
    session.streams.removeListener(listener)
    assert listener.counts["events"] == 3
