import math

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from thermoflow.functions import band, int_mean, ratio, room_partition, split_tokens
from thermoflow.functions.time import closer_than, duration_micros, interval
from thermoflow.operators import projections


@pytest.mark.parametrize("text, separator, expected", [
    ("a__b_", "_", ["a", "", "b"]), ("_", "_", []), ("", "_", [""]), ("_a", "_", ["", "a"]),
    ("hello world", " ", ["hello", "world"]), ("a|b||", "|", ["a", "b"]), ("a.b", ".", ["a", "b"]), (None, "_", None),
])
def test_split_tokens(spark, text, separator, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(split_tokens(F.col("t"), separator)).first()[0] == expected


def test_split_tokens_rejects_long_separators():
    with pytest.raises(ValueError):
        split_tokens(F.lit("a"), "ab")


def test_int_mean_cuts_towards_zero(spark):
    df = spark.createDataFrame([(-7, 2), (7, 2), (6, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(int_mean(F.col("a"), F.col("b"))).collect()] == [-3, 3, 2]


def test_ratio_of_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 2.0), (None, 0.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(ratio(a, b)).collect()] == [None, None, None, 0.5, None]
    out = [r[0] for r in df.select(ratio(a, b, ieee=True)).collect()]
    assert out[:2] == [math.inf, -math.inf] and math.isnan(out[2]) and out[3:] == [0.5, None]


def test_bands(spark):
    df = spark.createDataFrame([(19.99,), (20.0,), (29.99,), (30.0,), (None,)], "v double")
    assert [r[0] for r in df.select(band(F.col("v"))).collect()] == ["green", "#EAB839", "#EAB839", "red", None]


def test_room_partition(spark):
    df = spark.createDataFrame([("0_IN",), ("4_OUT",), ("7",)], "r string")
    assert [r[0] for r in df.select(room_partition(F.col("r"), 3)).collect()] == [0, 1, 1]


def test_durations(spark):
    assert duration_micros("5 seconds") == 5_000_000
    assert duration_micros("1 hour 30 minutes") == 5_400_000_000
    assert duration_micros("500 milliseconds") == 500_000
    with pytest.raises(ValueError):
        duration_micros("soon")
    df = spark.createDataFrame([(at(0), at(5)), (at(0), at(4.999999))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(closer_than(F.col("a"), F.col("b"), "5 seconds")).collect()] == [False, True]
    assert df.select(F.col("a") + interval("4999999 microseconds")).first()[0] == at(4.999999)


def test_projections(spark, readings):
    df = spark.createDataFrame([("room_1_IN", 24.9), ("room_2_OUT", 25.0)], "id string, temperature double")
    hot = projections.ids(projections.at_least(df))
    assert rows(hot) == [("room_2_OUT",)]
    assert rows(projections.tokens(hot, "id", "_")) == [("2",), ("OUT",), ("room",)]
    assert rows(projections.split_compound_id(df), "room", "source") == [("room_1", "IN"), ("room_2", "OUT")]
    texts = spark.createDataFrame([("a",), ("",), (None,)], "value string")
    assert rows(projections.non_empty(texts)) == [("a",)]
    assert rows(projections.upper_case(texts, "value")) == [("",), ("A",), (None,)]
    assert rows(projections.words_with_one(spark.createDataFrame([("b a",)], "text string"))) == [("a", 1), ("b", 1)]
