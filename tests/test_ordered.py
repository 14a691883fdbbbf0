"""Order-dependent operators must not depend on how the rows are cut into slices."""

import random

import pytest
from conftest import at, in_order, rows, same_rows
from pyspark.sql import functions as F

from thermoflow.model import READING_ORDER
from thermoflow.operators.ordered import Slices, ordered_parts, plan_slices, previous_row, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot room, a hot instant (a third of the rows) and times before 1970."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        second = 17.0 if i % 3 == 0 else rng.choice([-3e9, 0.0, 40.0]) + rng.random() * 30
        data.append(("hot" if rng.random() < 0.6 else str(rng.randrange(4)), "IN", at(second), rng.randrange(20, 40), i))
    rng.shuffle(data)
    schema = "room_id string, source string, ts timestamp_ntz, temperature int, event_id bigint"
    return spark.createDataFrame(data, schema).cache()


def brute(skewed, keys):
    state, out = {}, []
    for r in sorted(skewed.collect(), key=lambda r: (r.ts, r.event_id)):
        key = tuple(r[k] for k in keys)
        before, total = state.get(key, (None, 0))
        state[key] = (r.temperature, total + r.temperature)
        out.append((r.event_id, before, total + r.temperature))
    return in_order(out)


@pytest.mark.parametrize("keys", [(), ("room_id",), ("room_id", "source")])
@pytest.mark.parametrize("rows_per_slice", [7, 100, 10_000])
def test_previous_and_running(skewed, keys, rows_per_slice):
    previous = previous_row(skewed, keys, READING_ORDER, ("ts", "temperature"), rows_per_slice=rows_per_slice)
    running = running_totals(
        previous.drop("prev_ts"), keys, READING_ORDER, {"total": F.col("temperature")}, rows_per_slice=rows_per_slice
    )
    assert rows(running, "event_id", "prev_temperature", "total") == brute(skewed, keys)


def test_slices_split_one_instant(skewed):
    slices = plan_slices(skewed, READING_ORDER, 20)
    assert slices.count > 10
    sizes = [r["count"] for r in slices.add_to(skewed, "s").groupBy("s").count().collect()]
    assert sum(sizes) == 600 and max(sizes) < 100
    instant = slices.add_to(skewed.where(F.col("ts") == F.lit(at(17.0)).cast("timestamp_ntz")), "s")
    assert instant.select("s").distinct().count() > 3


def test_slice_numbers_follow_the_order(skewed):
    numbered = plan_slices(skewed, READING_ORDER, 50).add_to(skewed, "s").collect()
    numbers = [r["s"] for r in sorted(numbered, key=lambda r: (r.ts, r.event_id))]
    assert numbers == sorted(numbers)


def test_slices_of_a_larger_table_serve_a_filter(skewed):
    slices = plan_slices(skewed, READING_ORDER, 30)
    few = skewed.where("temperature > 35")
    same_rows(
        previous_row(few, (), READING_ORDER, ("event_id",), slices=slices),
        previous_row(few, (), READING_ORDER, ("event_id",)),
    )
    with pytest.raises(ValueError):
        previous_row(few, (), ("event_id",), ("ts",), slices=Slices(READING_ORDER, 1))


def test_only_times_and_whole_numbers_order(skewed):
    with pytest.raises(TypeError, match="room_id"):
        previous_row(skewed, (), ("ts", "room_id"), ("ts",))


def test_rows_without_a_time_are_kept_and_come_first(spark):
    data = [(None, 1), (at(1), 2), (None, 3), (at(0), 4), (at(2), 5)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, event_id bigint")
    for rows_per_slice in (1, 100):
        out = running_totals(df, (), READING_ORDER, {"n": F.lit(1)}, rows_per_slice=rows_per_slice)
        assert rows(out, "n", "event_id") == [(1, 1), (2, 3), (3, 4), (4, 2), (5, 5)]


def test_empty_table(spark, skewed):
    assert plan_slices(skewed.limit(0), READING_ORDER, 1).count == 0
    assert previous_row(skewed.limit(0), (), READING_ORDER, ("ts",)).count() == 0


@pytest.mark.parametrize("part_rows, rows_per_slice", [(50, 10_000), (50, 13), (1000, 60), (7, 100)])
def test_parts_are_whole_and_bounded(skewed, part_rows, rows_per_slice):
    parts = ordered_parts(
        skewed, ("room_id",), READING_ORDER, F.col("event_id"), part_rows, rows_per_slice=rows_per_slice,
        sums={"total": F.col("temperature")}, firsts={"first": F.col("event_id")},
    ).collect()
    expected = {}
    for r in sorted(skewed.collect(), key=lambda r: (r.ts, r.event_id)):
        expected.setdefault(r.room_id, []).append((r.event_id, r.temperature))
    assert max(p.n for p in parts) <= part_rows
    for room, values in expected.items():
        mine = sorted((p for p in parts if p.room_id == room), key=lambda p: p.part)
        assert [p.part for p in mine] == list(range(len(mine)))
        assert [i for p in mine for i in p["items"]] == [v[0] for v in values]
        assert sum(p.total for p in mine) == sum(v[1] for v in values)
        assert all(p.first == p["items"][0] for p in mine)
