"""Alerting: readings to warnings to alerts to counts, for tables and for streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from thermoflow.fixed_values import ALERT_GAP, OUT_OF_ORDERNESS, WARNING_GAP, WARNING_THRESHOLD, WATERMARK_INTERVAL
from thermoflow.model import READING_ORDER, WARNING
from thermoflow.operators.dashboard import alert_counter
from thermoflow.operators.metrics import counted
from thermoflow.operators.ordered import ROWS_PER_SLICE, plan_slices
from thermoflow.operators.patterns import alerts, warnings
from thermoflow.session import working_path
from thermoflow.streaming.event_time import with_event_time
from thermoflow.streaming.patterns import stream_alerts, stream_warnings, warning_delay


@dataclass(frozen=True)
class Alerting:
    """Settings of both stages."""

    threshold: int = WARNING_THRESHOLD
    warning_gap: str = WARNING_GAP
    alert_gap: str = ALERT_GAP
    scope: str = "global"
    exact: bool = False
    slice_width: str = "1 second"

    def tables(
        self, spark: SparkSession, readings: DataFrame, folder: str | None = None,
        rows_per_slice: int = ROWS_PER_SLICE,
    ) -> dict[str, DataFrame]:
        """Warnings, alerts and alert counts of a table of readings.

        Warnings are stored once (in ``folder`` or the shared working folder) and read
        from there by what follows, so the shuffle of all readings happens one time.
        """
        slices = plan_slices(readings, READING_ORDER, rows_per_slice)
        path = folder or working_path(spark, "warnings")
        found = warnings(readings, self.threshold, self.warning_gap, self.exact, slices)
        found.write.mode("overwrite").parquet(path)
        warned = spark.read.schema(found.schema).parquet(path)
        alerted = alerts(warned, self.alert_gap, self.scope, slices)
        return {"warnings": warned, "alerts": alerted, "alert_counts": alert_counter(alerted)}

    def start_warnings(
        self, readings: DataFrame, path: str, checkpoint: str, delay: str = OUT_OF_ORDERNESS, **trigger
    ) -> StreamingQuery:
        """Stream readings (no watermark yet) to a table of warnings."""
        warned = stream_warnings(
            with_event_time(readings, delay), self.threshold, self.warning_gap, self.exact, self.slice_width
        )
        return _store(warned, "warnings", path, checkpoint, trigger)

    def start_alerts(
        self, spark: SparkSession, warnings_path: str, path: str, checkpoint: str, **trigger
    ) -> StreamingQuery:
        """Stream the table of warnings to a table of alerts; the count is in the progress."""
        warned = with_event_time(
            spark.readStream.schema(WARNING).parquet(warnings_path),
            warning_delay(self.warning_gap, self.slice_width),
        )
        alerted = stream_alerts(warned, self.alert_gap, self.scope, self.slice_width)
        return _store(counted(alerted, "alerting", "alerts"), "alerts", path, checkpoint, trigger)


def _store(df: DataFrame, name: str, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        df.writeStream.format("parquet").queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": WATERMARK_INTERVAL}))
        .start(path)
    )
