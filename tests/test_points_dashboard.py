import math

from conftest import at, rows
from pyspark.sql import Observation, functions as F

from thermoflow.operators import dashboard, metrics, points
from thermoflow.operators.patterns import alerts, warnings
from thermoflow.operators.relation import relation
from thermoflow.sinks.points import read_points, write_lines, write_points
from thermoflow.sources.memory import from_rows


def test_reading_points(spark, readings, tmp_path):
    df = readings([("1", "out", -10, 10), ("1", "in", -7, 11), ("2", "in", -4, 9), ("2", "out", -1, 8)])
    out = points.reading_points(df)
    assert rows(out, "measurement", "room", "source", "temp")[0] == ("newrooms", "1", "in", 11)
    lines = [r["line"] for r in points.as_lines(out).orderBy("line").collect()]
    assert lines[0] == "newrooms,room=1,source=in temp=11i 1704067193000000000"
    write_lines(out, str(tmp_path / "lines"), per_file=2)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == lines


def test_line_protocol_leaves_out_what_no_store_accepts(spark):
    bad = [float("inf"), float("-inf"), float("nan"), None, 2.5]
    df = from_rows(spark, [("m", at(0), "a\nb\r", "", v) for v in bad],
                   "measurement string, time timestamp_ntz, room string, source string, value double")
    assert rows(points.as_lines(df)) == [("m,room=a\\ b\\  value=2.5 1704067200000000000",)]
    text = points.line_protocol(F.lit("m"), {}, {"s": (F.lit("two\nlines"), "string")}, F.col("time"))
    assert df.select(text).first()[0] == 'm s="two lines" 1704067200000000000'


def test_line_protocol_escapes(spark):
    df = from_rows(spark, [("a b,c", at(0), "r 1,=", None, 1.5), ("m", at(0), "x", "y", None)],
                   "measurement string, time timestamp_ntz, room string, source string, value double")
    assert rows(points.as_lines(df)) == [("a\\ b\\,c,room=r\\ 1\\,\\= value=1.5 1704067200000000000",)]
    text = points.line_protocol(F.lit("m"), {}, {"s": (F.lit('say "\\"'), "string"), "n": (F.lit(1), "int")}, F.col("time"))
    assert df.select(text).first()[0] == 'm n=1i,s="say \\"\\\\\\"" 1704067200000000000'


def test_stored_points(spark, readings, tmp_path):
    df = readings([("0", "IN", 0, 20), ("0", "OUT", 0, 40)])
    path = str(tmp_path / "points")
    write_points(points.relation_points(relation(df)), path)
    assert rows(read_points(spark, path, "rooms_avg"), "room", "time", "value") == [("0", at(5), 0.5)]
    assert read_points(spark, path, since=at(5)).count() == 1
    later = read_points(spark, path, "rooms_avg", since=at(6))
    assert later.count() == 0 and "day" not in later.columns


def values(spark, *data):
    return from_rows(spark, data, "room string, source string, time timestamp_ntz, value double")


def test_latest_is_strict(spark):
    df = values(spark, ("0", "IN", at(0), 1.0), ("0", "IN", at(1), 2.0), ("1", "IN", at(0), 3.0), ("2", "OUT", at(15), 4.0))
    assert rows(dashboard.latest(df, "IN", as_of=at(15))) == [("0", at(1), 2.0)]
    assert rows(dashboard.latest(df, "OUT")) == [("2", at(15), 4.0)]
    assert rows(dashboard.latest(df, "IN", "16 seconds"), "room", "value") == [("0", 2.0), ("1", 3.0)]


def test_series_grid_gauge_reduce(spark):
    df = values(spark, ("0", "IN", at(0), -1.0), ("0", "IN", at(1800), 0.5), ("1", "IN", at(1801), 9.0))
    assert [r["value"] for r in dashboard.series(df).collect()] == [0.5, 9.0]
    assert [r["value"] for r in dashboard.series(df, as_of=at(1800)).collect()] == [-1.0, 0.5, 9.0]
    assert [r["strength"] for r in dashboard.grid_cells(df).orderBy("time").collect()] == [0.0, 0.5, 1.0]
    gauges = dashboard.gauge(values(spark, ("0", "IN", at(0), 10.0), ("0", "IN", at(1), 50.0))).orderBy("time")
    assert [(r["band"], r["filled"]) for r in gauges.collect()] == [("green", 0.25), ("red", 1.0)]
    assert rows(dashboard.reduce_series(df)) == [("0", -0.25, 0.5), ("1", 9.0, 9.0)]


def test_alert_counter(readings):
    seconds = [0, 1, 2, 86400 * 3, 86400 * 3 + 1, 86400 * 3 + 2]
    df = readings([("0", "IN", s, 30 + 2 * (i % 3)) for i, s in enumerate(seconds)])
    out = dashboard.alert_counter(alerts(warnings(df)), "1 minute")
    assert rows(out, "source", "time", "alerts", "alerts_so_far") == [("IN", at(0), 1, 1), ("IN", at(86400 * 3), 1, 2)]


def test_counter_and_throughput(spark, readings):
    df = readings([("0", "IN", i, 20) for i in range(12)])
    seen = Observation("seen")
    assert metrics.counted(df, seen).where("temperature > 99").count() == 0
    assert seen.get == {"events": 12}
    assert rows(metrics.throughput(df), "window_start", "events", "per_second") == [
        (at(0), 5, 1.0), (at(5), 5, 1.0), (at(10), 2, 0.4),
    ]


def test_histograms(spark, readings):
    df = readings([("0", "IN", i * 3600, i) for i in range(1, 101)])
    whole = metrics.window_histogram(df, "365 days").collect()
    assert len(whole) == 1
    h = whole[0]
    assert (h["count"], h["min"], h["max"], h["mean"], h["p50"], h["p99"]) == (100, 1, 100, 50.5, 50.5, 99.01)
    assert math.isclose(h["stddev"], 29.011491975882016)
    recent = metrics.recent_histogram(df, size=10).first()
    assert (recent["count"], recent["min"], recent["max"]) == (10, 91, 100)
    assert metrics.recent_histogram(df, size=1000).first()["count"] == 100
    one = metrics.recent_histogram(df, size=1).first()
    assert (one["count"], one["stddev"]) == (1, None)
