import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from thermoflow.operators.running import mean_per_key, running_mean, running_sum, running_word_count, word_count
from thermoflow.sources.memory import from_rows

TEXTS = ["cold room", "warm hall", "cold cellar", "cellar hall"]


@pytest.mark.parametrize("rows_per_slice", [2, 1000])
def test_word_count(spark, rows_per_slice):
    df = from_rows(spark, list(enumerate(TEXTS)), "id bigint, text string")
    out = running_word_count(df, ("id",), rows_per_slice=rows_per_slice).orderBy("id", "position")
    assert [(r["word"], r["count"]) for r in out.collect()] == [
        ("cold", 1), ("room", 1), ("warm", 1), ("hall", 1), ("cold", 2), ("cellar", 1), ("cellar", 2), ("hall", 2),
    ]
    assert rows(word_count(df)) == [("cellar", 2), ("cold", 2), ("hall", 2), ("room", 1), ("warm", 1)]


@pytest.mark.parametrize("rows_per_slice", [1, 1000])
def test_running_mean(readings, rows_per_slice):
    df = readings([("0", "IN", 0, 3), ("0", "IN", 1, 4), ("0", "OUT", 2, 9), ("0", "IN", 2, -12)])
    out = running_mean(df, rows_per_slice=rows_per_slice)
    assert rows(out, "source", "count", "total", "mean") == [("IN", 1, 3, 3), ("IN", 2, 7, 3), ("IN", 3, -5, -1), ("OUT", 1, 9, 9)]
    assert rows(mean_per_key(df), "source", "count", "mean") == [("IN", 3, -1), ("OUT", 1, 9)]


def test_means_count_values_only(readings):
    df = readings([("0", "IN", 0, None), ("0", "IN", 1, 5), ("1", "IN", 2, None)])
    out = running_mean(df, rows_per_slice=1)
    assert rows(out, "room_id", "count", "mean") == [("0", 0, None), ("0", 1, 5), ("1", 0, None)]
    assert rows(mean_per_key(df), "room_id", "count", "mean") == [("0", 1, 5), ("1", 0, None)]


def test_running_sum_of_triplets(spark):
    df = from_rows(spark, [(5, 3, 1), (8, 4, 2), (5, 2, 3), (8, 7, 4)], "f0 int, f1 int, f2 int")
    out = running_sum(df, ("f0",), "f1", ("f2",)).groupBy("f0").agg(F.max_by("sum_f1", "f2").alias("last"))
    assert rows(out) == [(5, 5), (8, 11)]
    same_rows(running_sum(df, ("f0",), "f1", ("f2",), rows_per_slice=1), running_sum(df, ("f0",), "f1", ("f2",)))
