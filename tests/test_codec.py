import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from thermoflow.sources import codec, kafka
from thermoflow.sources.memory import from_rows, sensor_readings


def records(spark, *pairs):
    return from_rows(spark, pairs, "key string, value string")


def test_roundtrip(spark, readings):
    df = readings([("0", "IN", 1.5, 20), ("3", "OUT", 2, -4)], ntz=False)
    encoded = codec.encode_wire(df, "event_id")
    assert rows(encoded, "key", "value")[0] == ('{"roomId":"0_IN"}', '{"value":20,"timestamp":1704067201500}')
    same_rows(codec.accepted(codec.decode_wire(encoded)), df)


def test_binary_records(spark, readings):
    df = readings([("0", "IN", 1, 20)], ntz=False)
    encoded = codec.encode_wire(df).select(F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"))
    assert rows(codec.accepted(codec.decode_wire(encoded)), "room_id", "temperature") == [("0", 20)]


def test_dead_letters(spark):
    good = '{"value": 27, "timestamp": 1588000000000}'
    df = records(
        spark, ('{"roomId":"3_IN"}', good), ("{", good), ('{"roomId":"7"}', good), ('{"roomId":"3_"}', good),
        ('{"roomId":"3_IN"}', '{"timestamp": 1}'), ('{"roomId":"3_IN"}', '{"value": 1}'), ('{"roomId":"3_IN"}', "{"),
        ('{"roomId":"3_IN"}', '{"value": "hot", "timestamp": 1}'), (None, good), ('{"roomId":"3_IN"}', None),
        ('{"roomId":"3_IN"}', '{"value": 1, "timestamp": 99999999999999999}'),
    )
    decoded = codec.decode_wire(df)
    assert codec.accepted(decoded).count() == 1
    errors = [r["error"] for r in codec.dead_letters(decoded).collect()]
    assert sorted(errors) == [
        "no room", "no room", "no source", "no source", "no temperature", "no temperature",
        "no timestamp", "no timestamp", "no timestamp", "no timestamp",
    ]
    with pytest.raises(Exception, match="cannot decode"):
        codec.accepted(codec.decode_wire(df, strict=True)).collect()


def test_numbers_as_they_come(spark):
    df = records(
        spark, ('{"roomId":"3_IN_x"}', '{"value":"27","timestamp":"1588000000000"}'),
        ('{"roomId":"3_IN"}', '{"value":27.9,"timestamp":1.588e12}'),
    )
    out = codec.accepted(codec.decode_wire(df)).select("room_id", "source", F.unix_millis("ts"), "temperature")
    assert rows(out) == [("3", "IN", 1588000000000, 27)] * 2


def test_messages(spark):
    df = from_rows(spark, [("s", "r", 5, 'say "é"\n')], "sender string, recipient string, sentAt bigint, message string")
    same_rows(codec.decode_messages(codec.encode_messages(df)), df)
    broken = from_rows(spark, [("{",)], "value string")
    assert rows(codec.decode_messages(broken)) == [(None, None, None, None)]
    with pytest.raises(Exception):
        codec.decode_messages(broken, strict=True).collect()
    assert codec.event_time(df, unit="seconds").select(F.unix_millis("ts")).first()[0] == 5000
    assert codec.event_time(df).select(F.unix_millis("ts")).first()[0] == 5
    assert codec.encode_json(df, ("sentAt",)).first()[0] == '{"sentAt":5}'


def test_fixed_rows(spark):
    assert sensor_readings(spark, [(1, 1, 29.0, "IN")]).count() == 1
    with pytest.raises(ValueError):
        sensor_readings(spark, [(1, 1, 29.0, "UP")])


def test_topic_options():
    assert kafka.source_options("t", "b:9092", "g", "earliest", 10) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest",
        "groupIdPrefix": "g", "maxOffsetsPerTrigger": "10",
    }
    assert kafka.source_options("t", "b")["startingOffsets"] == "latest"
    assert kafka.sink_options("t", "b") == {"kafka.bootstrap.servers": "b", "topic": "t"}
    assert kafka.source_options("t", "b", fixed_group="own", max_records_per_batch=None)["kafka.group.id"] == "own"
    assert "maxOffsetsPerTrigger" in kafka.source_options("t", "b")
    assert "maxOffsetsPerTrigger" not in kafka.source_options("t", "b", max_records_per_batch=None)
    with pytest.raises(ValueError):
        kafka.source_options("t", "b", start="middle")
    with pytest.raises(ValueError):
        kafka.source_options("t", "b", "g", fixed_group="own")


def test_hostile_records_are_dead_letters(spark):
    room = '{"roomId":"1_IN"}'
    bad = [
        (room, '{"value":1,"timestamp":-9223372036854775808}'), (room, '{"value":1,"timestamp":9223372036854775807}'),
        (room, '{"value":1,"timestamp":1e300}'), (room, '{"value":{"a":1},"timestamp":5}'), (room, '{"value":3000000000,"timestamp":5}'),
        ('{"roomId":"7_XX"}', '{"value":1,"timestamp":5}'), ("", ""), (None, None), (room, '{"value":"","timestamp":5}'),
    ]
    decoded = codec.decode_wire(from_rows(spark, bad + [(room, '{"value":27.9,"timestamp":"5"}')], "key string, value string"))
    assert [r["error"] for r in codec.dead_letters(decoded).where("key LIKE '%XX%'").collect()] == ["unknown source"]
    assert codec.dead_letters(decoded).count() == len(bad) and codec.accepted(decoded).count() == 1
    anything = codec.decode_wire(from_rows(spark, bad[5:6], "key string, value string"), sources=None)
    assert codec.accepted(anything).first()["source"] == "XX"


def test_arrival_ids(spark):
    places = [(0, 0), (0, 7), (1, 3), (300, 10**12)]
    df = kafka.with_arrival_id(from_rows(spark, [("k", p, o) for p, o in places], "key string, partition int, offset bigint"))
    assert df.columns == ["key", "event_id"]
    ids = [r["event_id"] for r in df.collect()]
    assert ids == sorted(set(ids))


def test_topic_rows(spark):
    df = from_rows(spark, [("1", 5, "x")], "room string, n int, text string")
    assert rows(kafka.keyed_rows(df, ("room", "n"), "text")) == [("1|5", "x")]
    assert rows(kafka.keyed_rows(df, ("room",))) == [("1", '{"room":"1","n":5,"text":"x"}')]
    assert rows(kafka.constant_key_rows(df, "k", "text")) == [("k", "x")]
    raw = df.select(F.encode("room", "UTF-8").alias("key"), F.encode("text", "UTF-8").alias("value"), F.lit(1).alias("timestamp"))
    assert rows(codec.decode_raw(raw)) == [("1", "x", 1)]
