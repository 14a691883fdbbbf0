"""Late rows and corrections against a plain replay in order of arrival."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from thermoflow.operators.lateness import (
    ASCENDING, BOUNDED, PUNCTUATED, correction_log, judged_rows, late_rows, summed, upserted,
)
from thermoflow.operators.ordered import plan_slices, running_max

START = datetime(2024, 1, 1)
DELAYS = {ASCENDING: 1, BOUNDED: 3000, PUNCTUATED: 1500}


def _ms(n):
    return None if n is None else START + timedelta(milliseconds=n)


@pytest.fixture(scope="module")
def data():
    """(room, event time, arrival, value), times in milliseconds: a hot room, ties in arrival, NULLs."""
    rng = random.Random(3)
    out = []
    for i in range(500):
        ts = rng.randrange(60_000)
        arrival = ts + rng.choice([0, 0, 10, 2000, 4000, 9000])
        out.append((rng.choice(["hot"] * 5 + ["a", None]), ts, arrival // 100 * 100, rng.choice([None, 1, 2, 5])))
    return out + [("a", None, 30_000, 1), (None, 4999, 5000, 7)]


@pytest.fixture(scope="module")
def arrived(spark, data):
    made = [(r, "IN", _ms(ts), _ms(at), v, i) for i, (r, ts, at, v) in enumerate(data)]
    return spark.createDataFrame(
        made, "room_id string, source string, ts timestamp_ntz, arrival timestamp_ntz, temperature int, event_id bigint")


def _replay(data, delay, lateness, width=5000):
    """Row by row: the fates, and what is sent per window."""
    newest, fates, windows, log = None, {}, {}, []
    for i in sorted(range(len(data)), key=lambda i: (data[i][2], i)):
        room, ts, _, value = data[i]
        mark = None if newest is None else newest - delay
        if ts is None:
            fates[i] = "refused"
            continue
        end = ts // width * width + width
        over = mark is not None and mark >= end - 1
        fates[i] = "on_time" if not over else "refused" if mark >= end - 1 + lateness else "correction"
        newest = ts if newest is None else max(newest, ts)
        if fates[i] != "refused":
            windows.setdefault((room, end), []).append((fates[i] == "correction", value or 0))
    for (room, end), found in windows.items():
        first = [v for late, v in found if not late]
        sent = [(len(first), sum(first))] if first else []
        for late, v in found:
            if late:
                n, total = sent[-1] if sent else (0, 0)
                sent.append((n + 1, total + v))
        for version, (n, total) in enumerate(sent):
            if version:
                log.append((room, end, version - 1, "-", *sent[version - 1]))
            log.append((room, end, version, "+", n, total))
    return fates, log


@pytest.mark.parametrize("delay", list(DELAYS))
@pytest.mark.parametrize("per_slice", [3, 10_000])
def test_fates(arrived, data, delay, per_slice):
    slices = plan_slices(arrived, ("arrival", "event_id"), per_slice, span="3650 days")
    judged = judged_rows(arrived, "5 seconds", delay, "2 seconds", slices=slices)
    fates, _ = _replay(data, DELAYS[delay], 2000)
    assert {r.event_id: r.fate for r in judged.collect()} == fates
    assert set(fates.values()) == {"on_time", "correction", "refused"}
    refused, _ = _replay(data, DELAYS[delay], 0)
    assert sorted(r.event_id for r in late_rows(arrived, "5 seconds", delay).collect()) == sorted(
        i for i, fate in refused.items() if fate == "refused")


@pytest.mark.parametrize("per_slice", [3, 10_000])
@pytest.mark.parametrize("lateness", [0, 500, 2500, 100_000])
def test_log(arrived, data, lateness, per_slice):
    log = correction_log(
        arrived, F.col("temperature"), "5 seconds", delay=ASCENDING, lateness=f"{lateness} milliseconds", rows_per_slice=per_slice)
    _, expected = _replay(data, 1, lateness)
    mine = [(r.room_id, round((r.window_end - START).total_seconds() * 1000), r.version, r.op, r.n, r.total) for r in log.collect()]
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted(mine, key=key) == sorted(expected, key=key)


def test_folds_end_with_one_aggregation_over_all_rows(arrived):
    log = correction_log(arrived, F.col("temperature"), "5 seconds", delay=BOUNDED, lateness="1 hour")
    timed = arrived.where("ts IS NOT NULL").withColumn("temperature", F.coalesce("temperature", F.lit(0)))
    whole = timed.groupBy("room_id", "source", F.window("ts", "5 seconds")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("temperature").alias("total")
    ).select("room_id", "source", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n", "total")
    same_rows(upserted(log).drop("version"), whole)
    same_rows(summed(log), whole.groupBy("room_id", "source").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))


def test_empty_and_keyed(arrived):
    empty = arrived.limit(0)
    assert judged_rows(empty, "5 seconds").count() == 0
    assert correction_log(empty, F.col("temperature"), "5 seconds").count() == 0
    keyed = judged_rows(arrived, "5 seconds", ASCENDING, keys=("room_id",))
    one = judged_rows(arrived.where("room_id = 'a'"), "5 seconds", ASCENDING)
    same_rows(keyed.where("room_id = 'a'"), one)


@pytest.mark.parametrize("with_row", [True, False])
def test_running_max(arrived, with_row):
    slices = plan_slices(arrived, ("arrival", "event_id"), 4, span="3650 days")
    found = running_max(arrived, ("room_id",), ("arrival", "event_id"), {"top": F.col("temperature")}, with_row, slices)
    mine = {r.event_id: r.top for r in found.collect()}
    top, expected = {}, {}
    for r in sorted(arrived.collect(), key=lambda r: (r.arrival, r.event_id)):
        before = top.get(r.room_id)
        after = max((v for v in (before, r.temperature) if v is not None), default=None)
        top[r.room_id] = after
        expected[r.event_id] = after if with_row else before
    assert mine == expected
    assert rows(running_max(arrived.limit(0), (), ("arrival",), {"top": F.col("temperature")})) == []
