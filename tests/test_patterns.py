import random

import pytest
from conftest import at, in_order, rows

from thermoflow.operators.patterns import alerts, compat_alerts, warnings

HOT = ("room_id", "ts", "avg_temperature")


def test_largest_temperatures_do_not_overflow(readings):
    most = 2**31 - 1
    out = warnings(readings([("0", "IN", 0, most), ("0", "IN", 1, most)]))
    assert rows(out, "avg_temperature") == [(float(most),)]


def test_contiguity(readings):
    assert warnings(readings([("0", "IN", 0, 31), ("0", "IN", 1, 12), ("0", "IN", 2, 33)])).count() == 0


def test_overlap_and_alert(readings):
    found = warnings(readings([("0", "IN", 0, 31), ("0", "IN", 1, 32), ("0", "IN", 2, 33)]))
    assert rows(found, *HOT) == [("0", at(1), 31.0), ("0", at(2), 32.0)]
    assert rows(alerts(found), "room_id", "ts", "alerted_temperature") == [("0", at(2), 32.0)]


def test_exact_mean(readings):
    found = warnings(readings([("0", "IN", 0, 31), ("0", "IN", 1, 32)]), exact=True)
    assert rows(found, "avg_temperature") == [(31.5,)]


@pytest.mark.parametrize("gap, count", [(5.0, 0), (4.999, 1), (4.999999, 1), (0.0, 1)])
def test_within_is_strict(readings, gap, count):
    assert warnings(readings([("0", "IN", 0, 31), ("0", "IN", gap, 31)])).count() == count


def test_threshold_is_inclusive(readings):
    assert warnings(readings([("0", "IN", 0, 30), ("0", "IN", 1, 30)])).count() == 1
    assert warnings(readings([("0", "IN", 0, 29), ("0", "IN", 1, 30)])).count() == 0


def test_equal_means_make_no_alert(readings):
    assert alerts(warnings(readings([("0", "IN", 0, 31), ("0", "IN", 1, 31), ("0", "IN", 2, 31)]))).count() == 0


def test_scopes(readings):
    found = warnings(readings([("0", "IN", 0, 31), ("0", "IN", 1, 31), ("1", "IN", 1.5, 33), ("1", "IN", 2, 33)]))
    assert rows(alerts(found), "room_id", "alerted_temperature") == [("0", 33.0)]
    assert alerts(found, scope="room").count() == 0


def test_sources_are_apart(readings):
    only_out = readings([("0", "OUT", 0, 31), ("0", "OUT", 1, 32), ("0", "OUT", 2, 33)])
    found = alerts(warnings(only_out))
    assert rows(found, "source") == [("OUT",)]
    assert compat_alerts(found).count() == 0
    mixed = readings([("0", "IN", 0, 31), ("0", "OUT", 1, 5), ("0", "IN", 2, 32), ("0", "IN", 3, 33)])
    assert rows(compat_alerts(alerts(warnings(mixed))), "source", "alerted_temperature") == [("OUT", 32.0)]


def test_fixed_readings(readings):
    """Readings 29 to 32 a second apart: two warnings, one alert."""
    found = warnings(readings([("1", "IN", i, 28 + i) for i in range(1, 5)]))
    assert rows(found, "ts", "avg_temperature") == [(at(3), 30.0), (at(4), 31.0)]
    assert rows(alerts(found), "alerted_temperature") == [(31.0,)]


def scan(data, threshold=30, warning_gap=5.0, alert_gap=10.0, scope="global"):
    """The contract, one reading at a time."""
    last, found = {}, []
    for i, (room, source, second, temperature) in sorted(enumerate(data), key=lambda x: (x[1][2], x[0])):
        before = last.get((room, source))
        if before and before[1] >= threshold and temperature >= threshold and second - before[0] < warning_gap:
            found.append((room, source, second, i, float((before[1] + temperature) // 2)))
        last[room, source] = (second, temperature)
    last, alerted = {}, []
    for room, source, second, i, mean in found:
        key = (source,) if scope == "global" else (room, source)
        before = last.get(key)
        if before and before[1] < mean and second - before[0] < alert_gap:
            alerted.append((before[2], source, at(second), i, mean))
        last[key] = (second, mean, room)
    return [(r, s, at(t), i, m) for r, s, t, i, m in found], alerted


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_slice", [20, 100_000])
def test_random_readings(readings, seed, rows_per_slice):
    rng = random.Random(seed)
    second, data = 0.0, []
    for _ in range(500):
        second += rng.choice([0, 0.25, 0.5, 1, 2, 5])
        data.append((str(rng.choice([0, 0, 0, 1, 2])), rng.choice(["IN", "OUT"]), second, rng.randrange(27, 40)))
    df = readings(data)
    found = warnings(df, rows_per_slice=rows_per_slice)
    expected, _ = scan(data)
    assert rows(found, "room_id", "source", "ts", "event_id", "avg_temperature") == in_order(expected)
    for scope in ("global", "room"):
        _, alerted = scan(data, scope=scope)
        got = alerts(found, scope=scope, rows_per_slice=rows_per_slice)
        assert len(alerted) > 5
        assert rows(got, "room_id", "source", "ts", "event_id", "alerted_temperature") == in_order(alerted)
