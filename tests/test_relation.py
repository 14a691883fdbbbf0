import math

from conftest import at, rows, same_rows

from thermoflow.operators.relation import int_relation, relation, relation_by_join
from thermoflow.plans.main_job import window_points


def test_both_forms(readings):
    df = readings([
        ("0", "IN", 0, 20), ("0", "IN", 4, 21), ("0", "OUT", 1, 41), ("0", "OUT", 5, 10),
        ("1", "IN", 0, 20), ("1", "OUT", 7, 40), ("2", "IN", 5, 30), ("2", "OUT", 9.999, 15),
    ])
    out = relation(df)
    assert rows(out, "room_id", "relation", "window_end") == [("0", 0.5, at(5)), ("2", 2.0, at(10))]
    same_rows(out, relation_by_join(df))


def test_zero_denominator(readings):
    df = readings([("0", "IN", 0, 1), ("0", "OUT", 0, 0), ("1", "IN", 0, 0), ("1", "OUT", 0, 0), ("2", "IN", 0, -1), ("2", "OUT", 0, 0)])
    for form in (relation, relation_by_join, int_relation):
        assert [r["relation"] for r in form(df).collect()] == [None] * 3
        out = {r["room_id"]: r["relation"] for r in form(df, ieee=True).collect()}
        assert out["0"] == math.inf and math.isnan(out["1"]) and out["2"] == -math.inf


def test_int_relation(readings):
    df = readings([("0", "IN", 0, 3), ("0", "IN", 0.5, 4), ("0", "OUT", 0.9, 2), ("0", "IN", 1, 9)])
    assert rows(int_relation(df), "room_id", "relation", "relation_text", "window_end") == [("0", 1.5, "1.5", at(1))]


def test_points_of_one_sided_windows(readings):
    df = readings([("0", "IN", 0, 20), ("0", "OUT", 0, 40), ("1", "IN", 0, 30)])
    assert rows(window_points(df), "measurement", "room", "source", "value", "time") == [
        ("rooms_avg", "0", None, 0.5, at(5)), ("rooms_temperatures", "0", "IN", 20.0, at(5)),
        ("rooms_temperatures", "0", "OUT", 40.0, at(5)), ("rooms_temperatures", "1", "IN", 30.0, at(5)),
    ]
