"""Meters, counters with restarts, quantile sketches, newest values and the table of latest values."""

import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from thermoflow.operators import dashboard, distributions, meters
from thermoflow.session import stream_session
from thermoflow.sinks.latest import LatestTable, keep_latest, newest_rows

START = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("per_slice", [3, 10_000])
def test_sliding_throughput(readings, per_slice):
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 5 + ["a", None]), "IN", rng.randrange(4000) / 100, 1) for _ in range(300)]
    found = meters.sliding_throughput(readings(data), keys=("room_id",), rows_per_slice=per_slice)
    mine = {(r.room_id, round((r.time - START).total_seconds())): r.events for r in found.collect()}
    for room in ("hot", "a", None):
        seconds = [int(s) for r, _, s, _ in data if r == room]
        steps = {s for s in seconds} | {s + 5 for s in seconds}
        assert {t - 1: n for (r, t), n in mine.items() if r == room} == {
            t: sum(t - 5 < s <= t for s in seconds) for t in steps}
    assert meters.sliding_throughput(readings([])).count() == 0
    with pytest.raises(ValueError):
        meters.sliding_throughput(readings(data), "2500 milliseconds")


def test_sliding_throughput_does_not_copy_rows(readings):
    df = readings([("a", "IN", i, 1) for i in range(50)])
    text = plan(meters.sliding_throughput(df, "1 hour"))
    assert "Expand" not in text and re.search(r"HashAggregate\(.*partial_count", text)


@pytest.mark.parametrize("per_slice", [2, 10_000])
def test_counter_with_restarts(readings, per_slice):
    values = [5, 7, 7, 2, None, 3, 0, 4]
    df = readings([("a", "IN", i, v) for i, v in enumerate(values)] + [(None, "IN", i, i) for i in range(3)])
    found = meters.counter_rate(df, "1 minute", "temperature", ("room_id",), rows_per_slice=per_slice)
    assert rows(found.select("room_id", "increase", "restarts")) == [("a", 2 + 0 + 2 + 1 + 0 + 4, 2), (None, 2, 0)]
    assert meters.counter_rate(df.limit(0), "1 minute", "temperature").count() == 0


def test_sketches_keep_their_error_when_merged(spark):
    df = spark.range(200_000).select(
        F.timestamp_micros(F.col("id") * 30_000).alias("ts"), (F.pmod(F.xxhash64("id"), F.lit(1 << 20))).cast("int").alias("temperature"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 12).cast("string"))).alias("room_id"),
    )
    sketches = distributions.value_sketches(df, "1 minute", keys=("room_id",))
    assert sketches.count() > 400
    found = distributions.merged_quantiles(sketches, ("room_id",), until=datetime(1970, 1, 1, 1), quantiles=(0.01, 0.5, 0.999))
    part = df.where(F.col("ts") < datetime(1970, 1, 1, 1))
    for r in found.collect():
        values = sorted(x.temperature for x in part.where(F.col("room_id") == r.room_id).collect())
        assert (r.n, r.min, r.max) == (len(values), values[0], values[-1])
        for q, estimate in ((0.01, r.p1), (0.5, r.p50), (0.999, r.p99_9)):
            below, up_to = (sum(v < estimate for v in values), sum(v <= estimate for v in values))
            error = distributions.RANK_ERROR * len(values) + 1
            assert below <= q * len(values) + error and up_to >= q * len(values) - error
    assert max(len(r.sketch) for r in sketches.collect()) < 16_000


def test_sketches_of_nulls_and_nothing(readings):
    nulls = readings([("a", "IN", 0, None)])
    assert distributions.value_sketches(nulls).count() == 0
    assert distributions.merged_quantiles(distributions.value_sketches(nulls)).count() == 0
    ties = distributions.merged_quantiles(distributions.value_sketches(readings([("a", "IN", i, 7) for i in range(50)])))
    assert set(ties.drop("n").first()) == {7}


def test_newest_per_key(readings):
    rng = random.Random(2)
    data = [(rng.choice(["hot"] * 8 + ["a", None]), "IN", rng.randrange(20), rng.randrange(50)) for _ in range(400)]
    found = distributions.newest_per_key(readings(data), 30, shares=4)
    for room in ("hot", "a", None):
        mine = sorted(r.event_id for r in found.collect() if r.room_id == room)
        ordered = sorted((s, i) for i, (r, _, s, _) in enumerate(data) if r == room)
        assert mine == sorted(i for _, i in ordered[-30:])
    assert plan(found).count("WindowGroupLimit") >= 2
    assert distributions.newest_per_key(readings([]), 3).count() == 0


@pytest.fixture
def points(spark):
    rng = random.Random(4)
    made = [(START + timedelta(seconds=rng.randrange(60)), rng.choice(["0", "1", "2", None]), rng.choice(["IN", "OUT"]),
             rng.choice([None, 1.0, 2.0])) for _ in range(120)]
    return spark.createDataFrame(made, "time timestamp, room string, source string, value double")


def test_latest_table_after_batches(spark, tmp_path, points):
    state = LatestTable(spark, str(tmp_path / "latest"))
    parts = [points.where(F.pmod(F.xxhash64("time"), F.lit(5)) == i) for i in (3, 0, 4, 1, 2)]
    seen = None
    for number, part in enumerate(parts):
        assert state.merge(part, "s", number) and not state.merge(part, "s", number)
        seen = part if seen is None else seen.unionByName(part)
        same_rows(state.read(), newest_rows(seen))
    for source in ("IN", "OUT"):
        same = state.read().where(F.col("source") == source).select("room", "time")
        same_rows(same, dashboard.latest(points, source).select("room", "time"))


def test_expired_and_late_rows(spark, tmp_path):
    state = LatestTable(spark, str(tmp_path / "latest"))
    make = lambda *found: spark.createDataFrame(
        [(START + timedelta(seconds=s), room, "IN", v) for s, room, v in found], "time timestamp, room string, source string, value double")
    state.merge(make((0, "a", 1.0), (1, "b", 1.0)), "s", 0)
    state.merge(make((15, "b", 2.0)), "s", 1)
    assert rows(state.read(), "room", "value") == [("b", 2.0)]
    state.merge(make((0, "a", 3.0), (14, "b", 3.0)), "s", 2)
    assert rows(state.read(), "room", "value") == [("b", 2.0)]
    state.merge(make(), "s", 3)
    assert rows(state.read(), "room", "value") == [("b", 2.0)]


def test_latest_of_a_stream(spark, tmp_path, points):
    session, source = stream_session(spark, 2), str(tmp_path / "in")
    for i in range(3):
        points.where(F.pmod(F.xxhash64("time"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(source)
    stream = session.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(source)
    keep_latest(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "latest", availableNow=True).awaitTermination()
    same_rows(LatestTable(spark, str(tmp_path / "out")).read(), newest_rows(points))
