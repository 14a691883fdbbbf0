"""The physical plans: what reaches the scan, how often rows are shuffled, what is reused."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from thermoflow.model import READING_ORDER
from thermoflow.operators import patterns, relation
from thermoflow.operators.ordered import plan_slices
from thermoflow.plans import registered
from thermoflow.sinks.points import read_points, write_points
from thermoflow.sources.events import readings_from_events, table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(name for name in registered.registered() if not name.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(registered.registered()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups"):
        assert operator not in text


@pytest.mark.parametrize("name, exchanges", [
    ("readings_in", 0), ("hot_ids_split", 0), ("readings_roundtrip", 0), ("in_out_relation", 1), ("main_job_points", 1),
    ("window_avg_in", 1), ("window_sum_keyed", 1), ("word_count", 1), ("mean_per_key", 1),
    ("value_histogram", 2), ("throughput", 1),
])
def test_number_of_shuffles(spark, name, exchanges):
    text = plan(registered.registered()[name](spark, SF))
    assert len(re.findall(r"\bExchange\b", text)) == exchanges


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(registered.registered()["readings_in"](spark, SF).select("ts"))
    assert "PushedFilters: [In(event_type, [click,view])]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_partial_aggregation_before_the_shuffle(spark):
    text = plan(registered.registered()["in_out_relation"](spark, SF))
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate\(.*partial_avg", text)


def ran(df) -> str:
    """The plan as it ran, without the one that was planned first."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name, table_name", [
    ("warnings_in", "events"), ("running_mean", "events"), ("running_sum", "events"), ("window_concat", "events"),
    ("int_avg_values", "events"), ("running_word_count", "conversations"),
])
def test_ordered_operators_scan_and_shuffle_rows_once(spark, name, table_name):
    text = ran(registered.registered()[name](spark, SF))
    assert len(re.findall(rf"FileScan parquet .*/{table_name}.parquet", text)) == 1
    assert len(re.findall(r"- Exchange hashpartitioning\(_group#\d+, _slice#\d+, 8\), REPARTITION_BY_COL", text)) == 1
    assert "ReusedExchange" in text and "SinglePartition" not in text


def test_alerts_compute_warnings_once(spark):
    readings = readings_from_events(table(spark, SF, "events"))
    slices = plan_slices(readings, READING_ORDER, 60, span="3650 days")
    assert slices.count > 10
    alerted = patterns.alerts(patterns.warnings(readings, within="1 hour", slices=slices), "2 hours", slices=slices)
    text = ran(alerted)
    assert len(re.findall(r"FileScan parquet .*/events.parquet", text)) == 1


def test_point_folders_are_skipped(spark, tmp_path):
    readings = readings_from_events(table(spark, SF, "events"))
    points = relation.relation(readings, "1 hour").select(
        F.lit("rooms_avg").alias("measurement"), F.col("window_end").alias("time"), F.col("room_id").alias("room"),
        F.col("relation").alias("value"),
    )
    path = str(tmp_path / "points")
    write_points(points, path)
    last = points.agg(F.max("time")).first()[0]
    stored = read_points(spark, path, "rooms_avg", since=last.replace(hour=0, minute=0, second=0, microsecond=0))
    assert "PartitionFilters: [isnotnull(measurement" in plan(stored)
    assert stored.count() == points.where(F.to_date("time") == F.lit(last.date())).count()
