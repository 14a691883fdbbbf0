"""Patterns of any length against a plain search, with matches that span many slices."""

import random

import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from thermoflow.model import READING_ORDER
from thermoflow.operators.ordered import plan_slices, previous_rows
from thermoflow.operators.sequences import Pattern, flat_select, matches, runs, select
from thermoflow.session import stream_session
from thermoflow.sinks.commits import CommittedTable
from thermoflow.streaming.event_time import with_event_time
from thermoflow.streaming.sequences import MATCHES, store_matches


def _hot(event, taken):
    return event["temperature"] >= 30


def _rising(event, taken):
    return event["temperature"] > taken["first"][-1]["temperature"]


@pytest.fixture(scope="module")
def data():
    """Ties in time, a hot room with most rows, NULL rooms, NULL values and single rows."""
    rng = random.Random(7)
    out = []
    for _ in range(600):
        room = rng.choice(["hot"] * 6 + ["a", "b", None])
        out.append((room, "IN", rng.randrange(200), rng.choice([None, 28, 29, 30, 31, 32, 33, 34])))
    return out + [("single", "OUT", 5, 40)]


def _by_key(data):
    keyed = {}
    for i, (room, source, second, temperature) in enumerate(data):
        keyed.setdefault((room, source), []).append((second, i, temperature))
    return {key: sorted(found) for key, found in keyed.items()}


def _cut(readings, data, per_slice):
    df = readings(data)
    slices = plan_slices(df, READING_ORDER, per_slice, span="3650 days")
    assert slices.count > 10
    return df, slices


@pytest.mark.parametrize("per_slice", [2, 11])
@pytest.mark.parametrize("count", [1, 3, 8])
def test_previous_rows(readings, data, per_slice, count):
    df, slices = _cut(readings, data, per_slice)
    found = previous_rows(df, ("room_id", "source"), READING_ORDER, ("event_id",), count, slices=slices)
    mine = {r.event_id: [p.event_id for p in r.previous] for r in found.collect()}
    expected = {}
    for ordered in _by_key(data).values():
        for at, (_, i, _) in enumerate(ordered):
            expected[i] = [j for _, j, _ in ordered[max(0, at - count): at]]
    assert mine == expected


@pytest.mark.parametrize("per_slice", [2, 11])
def test_matches_of_four_steps(readings, data, per_slice):
    df, slices = _cut(readings, data, per_slice)
    pattern = Pattern().begin("first", _hot, times=2).next("second", _rising).next("third").within("6 seconds")
    found = matches(df, pattern, slices=slices).select(
        F.col("first")[0]["event_id"].alias("a"), F.col("first")[1]["event_id"].alias("b"),
        F.col("second.event_id").alias("c"), F.col("third.event_id").alias("d"),
    )
    expected = []
    for ordered in _by_key(data).values():
        for (s, a, t), (_, b, u), (_, c, v), (e, d, _) in zip(ordered, ordered[1:], ordered[2:], ordered[3:]):
            if None not in (t, u, v) and t >= 30 and u >= 30 and v > u and e - s < 6:
                expected.append((a, b, c, d))
    assert expected and rows(found) == sorted(expected)


def test_contiguity_limit_and_overlap(readings):
    pattern = Pattern().begin("first", _hot).next("second", _hot).within("5 seconds")
    ids = lambda data: [(r.first.event_id, r.second.event_id) for r in matches(readings(data), pattern).collect()]
    assert ids([("0", "IN", 0, 31), ("0", "IN", 1, 12), ("0", "IN", 2, 33)]) == []
    assert sorted(ids([("0", "IN", 0, 31), ("0", "IN", 1, 32), ("0", "IN", 2, 33)])) == [(0, 1), (1, 2)]
    assert ids([("0", "IN", 0, 31), ("0", "IN", 5, 31)]) == []
    assert ids([("0", "IN", 0, 31), ("0", "IN", 4.999, 31)]) == [(0, 1)]
    assert ids([("0", "IN", 0, 31), ("1", "IN", 1, 31)]) == []
    assert ids([]) == []


def test_one_step_and_results(readings):
    df = readings([("0", "IN", 0, 31), ("0", "IN", 1, 12), ("1", "IN", 2, None)])
    found = matches(df, Pattern().begin("first", _hot))
    assert rows(select(found, F.col("first.event_id").alias("id"))) == [(0,)]
    twice = F.array_repeat(F.struct(F.col("first.event_id").alias("id")), 2)
    assert rows(flat_select(matches(df, Pattern().begin("first")), twice)) == [(0,), (0,), (1,), (1,), (2,), (2,)]


def test_patterns_that_make_no_sense(readings):
    with pytest.raises(ValueError):
        Pattern().next("first")
    with pytest.raises(ValueError):
        Pattern().begin("first").begin("again")
    with pytest.raises(ValueError):
        Pattern().begin("first").next("first")
    with pytest.raises(ValueError):
        Pattern().begin("first", times=0)
    with pytest.raises(ValueError):
        matches(readings([]), Pattern())


def test_columns_with_the_names_of_helpers(readings):
    df = readings([("0", "IN", 0, 31), ("0", "IN", 1, 32)]).withColumns({c: F.lit(c) for c in ("previous", "run", "n")})
    found = matches(df, Pattern().begin("first", _hot).next("second", _hot)).first()
    assert (found.first.previous, found.second.n) == ("previous", "n")


@pytest.mark.parametrize("per_slice", [3, 50])
def test_runs(readings, data, per_slice):
    df, slices = _cut(readings, data, per_slice)
    found = runs(df, lambda before, row: before["temperature"] <= row["temperature"], {"total": F.sum("temperature")},
                 at_least=2, slices=slices)
    mine = rows(found.select(F.col("first.event_id").alias("a"), F.col("last.event_id").alias("b"), "n", "total"))
    expected = []
    for ordered in _by_key(data).values():
        run = []
        for row in [*ordered, None]:
            if row and run and None not in (run[-1][2], row[2]) and run[-1][2] <= row[2]:
                run.append(row)
                continue
            if len(run) > 1:
                expected.append((run[0][1], run[-1][1], len(run), sum(t for _, _, t in run)))
            run = [row]
    assert mine == sorted(expected)


def test_a_run_that_never_ends(readings):
    df = readings([("hot", "IN", i, 1) for i in range(400)])
    slices = plan_slices(df, READING_ORDER, 5, span="3650 days")
    found = runs(df, lambda before, row: F.lit(True), {}, slices=slices).collect()
    assert [(r.n, r.first.event_id, r.last.event_id) for r in found] == [(400, 0, 399)]
    assert runs(df.limit(0), lambda before, row: F.lit(True), {}).count() == 0


@pytest.mark.parametrize("dies", [False, True])
def test_matches_of_a_stream(spark, tmp_path, readings, monkeypatch, dies):
    """Batch by batch, with keys whose last row lies many batches back, and a job that dies between its two tables."""
    rng = random.Random(9)
    data = [(rng.choice(["hot"] * 5 + ["a", None]), "IN", i / 4, rng.randrange(28, 40)) for i in range(240)]
    data = [("rare", "IN", i / 4, 30 + i // 100) if i % 100 == 1 else r for i, r in enumerate(data)]
    df, session, source = readings(data, ntz=False), stream_session(spark, 2), str(tmp_path / "in")
    for i in range(4):
        df.where(F.col("event_id").between(i * 60, i * 60 + 59)).coalesce(1).write.mode("append").parquet(source)
    pattern = Pattern().begin("first", _hot, times=2).next("second", _rising)

    def results(found):
        return found.select(F.col("first")[0]["event_id"].alias("a"), F.col("first")[1]["event_id"].alias("b"), F.col("second.event_id").alias("c"))

    def run():
        files = session.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        store_matches(
            with_event_time(files, "1 second"), pattern, results, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "m",
            state_rows=10, availableNow=True,
        ).awaitTermination()

    if dies:
        real, calls = CommittedTable.commit, []

        def commit(self, *args, **options):
            calls.append(self._path)
            if self._path.endswith("last-rows") and len(calls) == 4:
                raise OSError("killed")
            return real(self, *args, **options)

        monkeypatch.setattr(CommittedTable, "commit", commit)
        with pytest.raises(Exception, match="killed"):
            run()
    run()
    closed = df.where("ts < TIMESTAMP '2024-01-01 00:00:58'")
    same_rows(CommittedTable(spark, str(tmp_path / "out" / MATCHES)).read(), results(matches(closed, pattern)))
    assert results(matches(closed, pattern)).where("c % 100 = 1").count() >= 1
