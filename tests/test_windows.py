from conftest import at, rows, same_rows
from pyspark.sql import functions as F

from thermoflow.operators import ordered, windows
from thermoflow.operators.keying import key_at, rebalance, with_partition, write_by_partition
from thermoflow.sources.memory import from_rows


def by_value(spark, data, schema):
    """Event time taken from the value itself, in seconds since 1970."""
    df = from_rows(spark, [(*row, i) for i, row in enumerate(data)], f"{schema}, event_id bigint")
    return df.withColumn("ts", F.timestamp_seconds("value"))


def test_keyed_sum(spark):
    df = by_value(spark, [("room_2_out", 20), ("room_2_out", 40), ("room_1_in", 21), ("room_2_in", 22)], "id string, value int")
    out = windows.window_sum(df, "5 seconds", (key_at(df, 0),), "value")
    assert rows(out.select("id", F.unix_seconds("window_start"), "total")) == [
        ("room_1_in", 20, 21), ("room_2_in", 20, 22), ("room_2_out", 20, 20), ("room_2_out", 40, 40),
    ]


def test_global_sum_takes_other_fields_from_the_first_row(spark):
    rooms = ["room_16"] * 5 + ["room_14"] * 3 + ["room_15"]
    df = by_value(spark, [(room, 5) for room in rooms], "id string, value int")
    out = windows.window_sum(df, "10 seconds", value="value", first_of=("id",))
    assert rows(out.select(F.unix_seconds("window_start"), "id", "total")) == [(0, "room_16", 45)]


def test_max_row(spark):
    data = [("s1", "r1", at(1500), "a", 0), ("s1", "r2", at(300), "b", 1), ("s1", "r3", at(0), "c", 2),
            ("s2", "r4", at(300.5), "d", 3), ("s3", "r5", at(300.5), "e", 4)]
    df = from_rows(spark, data, "sender string, recipient string, ts timestamp_ntz, message string, event_id bigint")
    out = windows.window_max_row(df, "ts")
    assert rows(out, "window_start", "recipient", "message") == [
        (at(0), "r3", "c"), (at(300), "r4", "d"), (at(1500), "r1", "a"),
    ]


def test_mean_and_window_edges(readings):
    df = readings([("0", "IN", 0, 20), ("0", "IN", 4.999999, 21), ("0", "IN", 5, 40)])
    assert rows(windows.window_mean(df), "avg_temperature", "window_start", "window_end") == [
        (20.5, at(0), at(5)), (40.0, at(5), at(10)),
    ]


def test_int_mean_values(readings):
    df = readings([("0", "IN", 2, -3), ("0", "IN", 1, -4), ("0", "OUT", 1, 7), ("0", "IN", 6, 1)])
    out = windows.window_int_mean_values(df, "5 seconds")
    assert rows(out, "source", "window_start", "part", "avg_temperature", "values") == [
        ("IN", at(0), 0, -3, "-4, -3, "), ("IN", at(5), 0, 1, "1, "), ("OUT", at(0), 0, 7, "7, "),
    ]
    cut = windows.window_int_mean_values(df, "5 seconds", part_rows=1)
    assert [r[1:] for r in rows(cut.where("source = 'IN'"), "window_start", "part", "avg_temperature", "values")] == [
        (0, -3, "-4, "), (1, -3, "-3, "), (0, 1, "1, "),
    ]
    same_rows(out.select("room_id", "source", "avg_temperature", "window_start", "window_end"), windows.window_int_mean(df, "5 seconds"))


def test_concat(spark):
    data = [("b", "x", at(2), 1), ("a", "yy", at(1), 2), ("b", "zzz", at(1), 0), ("a", "w", at(7), 3)]
    df = from_rows(spark, data, "key string, value string, ts timestamp_ntz, event_id bigint")
    out = windows.window_concat(df, F.col("value"), first_of="key")
    assert rows(out, "window_start", "part", "key", "n", "text") == [(at(0), 0, "b", 3, "zzzyyx"), (at(5), 0, "a", 1, "w")]
    cut = windows.window_concat(df, F.col("value"), first_of="key", part_rows=2)
    assert rows(cut, "window_start", "part", "key", "n", "text") == [
        (at(0), 0, "b", 2, "zzzyy"), (at(0), 1, "b", 1, "x"), (at(5), 0, "a", 1, "w"),
    ]
    lengths = windows.window_concat(df, F.length("value").cast("string"), keys=("key",))
    assert rows(lengths, "key", "window_start", "text") == [("a", at(0), "2"), ("a", at(5), "1"), ("b", at(0), "31")]


def test_long_texts_make_shorter_parts(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PART_BYTES", 100)
    texts = ["a" * 30, "b", "c" * 250, "d", "e" * 20]
    df = from_rows(spark, [(t, at(i / 10), i) for i, t in enumerate(texts)], "value string, ts timestamp_ntz, event_id bigint")
    for rows_per_slice in (2, 100):
        out = windows.window_concat(df, F.col("value"), part_rows=10, rows_per_slice=rows_per_slice).orderBy("part").collect()
        # Ten bytes count as a row: 3 + 1 + 25 rows, then rows 29 and 30.
        assert [(r["part"], r["text"]) for r in out] == [(0, "a" * 30 + "b" + "c" * 250), (2, "d"), (3, "e" * 20)]


def test_backup(spark):
    data = [("s", "r", 2, "m2", at(2), 1), ("s", "r", 1, "m1", at(1), 2), ("t", "r", 9, "m3", at(9), 3)]
    df = from_rows(spark, data, "sender string, recipient string, sentAt bigint, message string, ts timestamp_ntz, event_id bigint")
    out = windows.window_backup(df).orderBy("window_start").collect()
    assert [[m.message for m in r.inputMessages] for r in out] == [["m1", "m2"], ["m3"]]
    stamped = windows.stamp_backup(windows.window_backup(df)).collect()
    assert len({r.uuid for r in stamped}) == 2 and all(r.backupTimestamp for r in stamped)


def test_keying(spark, readings, tmp_path):
    df = readings([(str(i), "IN", i * 50_000, 20) for i in range(6)])
    assert rebalance(df, 3).rdd.getNumPartitions() == 3
    same_rows(rebalance(df), df)
    assert rows(with_partition(df, "room_id", 4), "room_id", "partition")[4:] == [("4", 0), ("5", 1)]
    write_by_partition(df, str(tmp_path / "out"), "room_id", 2)
    stored = spark.read.parquet(str(tmp_path / "out"))
    same_rows(stored.select(*df.columns), df)
    assert stored.where("partition = 1").count() == 3
