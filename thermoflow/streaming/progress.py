"""Counters of running streams, summed over their micro-batches."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.streaming import StreamingQueryListener


class CounterListener(StreamingQueryListener):
    """Adds up what ``operators.metrics.counted`` observes; one number per counter.

    Register it with ``spark.streams.addListener``. ``late`` counts the rows that came
    after their window had closed.
    """

    def __init__(self) -> None:
        self.counts: Counter[str] = Counter()
        self.late = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for observed in (event.progress.observedMetrics or {}).values():
            for name, value in observed.asDict().items():
                self.counts[name] += value or 0
        self.late += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        pass
