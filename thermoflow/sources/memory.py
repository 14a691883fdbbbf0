"""Bounded source from given rows (fixtures, small reference data)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def sensor_readings(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """Fixed readings ``(room_id, timestamp, temperature, in_out)``; the side must be IN or OUT."""
    rows = [tuple(row) for row in rows]
    wrong = sorted({str(row[3]) for row in rows} - {"IN", "OUT"})
    if wrong:
        raise ValueError(f"in_out must be IN or OUT, not {wrong}")
    return from_rows(spark, rows, "room_id bigint, timestamp bigint, temperature double, in_out string")
