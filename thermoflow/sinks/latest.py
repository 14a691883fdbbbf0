"""The latest value per key, kept up to date batch by batch.

A dashboard that asks for the newest value of each room would read all points at each refresh. This table has one row per
key instead. A batch is merged into it: the later row of a key wins, and rows that have become older than the horizon, seen
from the newest row of all, are dropped; so the table stays as small as the number of keys that were heard of lately. It lies in a table
with a commit list, which each batch replaces in one step and at most once.

A late row never brings an expired key back, as it is older than the horizon itself. Ties in time go to the larger value, a NULL being the least; rows without a time
are left out, NULL keys are keys like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from thermoflow.fixed_values import LATEST_RANGE
from thermoflow.functions.time import interval
from thermoflow.sinks.commits import CommittedTable
from thermoflow.sinks.points import FILE_INTERVAL

KEYS = ("room", "source")


def newest_rows(points: DataFrame, keys: Sequence[str] = KEYS, time: str = "time", value: str = "value",
                horizon: str = LATEST_RANGE, now: Column | None = None) -> DataFrame:
    """``keys, time, value`` of the newest row per key, where it is younger than the horizon (strictly).

    ``now`` is the newest time, if it is known.
    """
    timed = points.where(F.col(time).isNotNull())
    best = F.max(F.struct(time, value)).alias("_best")
    newest = timed.groupBy(*keys).agg(best).select(*keys, "_best.*")
    now = newest.agg(F.max(time)).scalar() if now is None else now
    return newest.where(F.col(time) > now - interval(horizon))


class LatestTable:
    """Holds ``keys, time, value``; ``merge`` takes the next batch of points."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = KEYS, horizon: str = LATEST_RANGE):
        self._table, self._keys, self._horizon = CommittedTable(spark, path), tuple(keys), horizon

    def merge(self, points: DataFrame, stream: str, batch: int) -> bool:
        """Take in a batch; False if it has been taken in already. One batch at a time: of two that meet, one fails."""
        listed = self._table.listed()
        if listed.streams.get(stream, -1) >= batch:
            return False
        rows = points.select(*self._keys, "time", "value")
        if listed.folders:
            rows = self._table.read(listed).unionByName(rows)
        state = newest_rows(rows, self._keys, horizon=self._horizon)
        name = self._table.stage(state)
        return self._table.commit([name], state.schema, remove=listed.folders, stream=stream, batch=batch)

    def read(self) -> DataFrame:
        return self._table.read()


def keep_latest(
    points: DataFrame, path: str, checkpoint: str, stream: str, keys: Sequence[str] = KEYS, horizon: str = LATEST_RANGE, **trigger
) -> StreamingQuery:
    """Stream points into a :class:`LatestTable`."""
    def write(batch: DataFrame, number: int) -> None:
        LatestTable(batch.sparkSession, path, keys, horizon).merge(batch, stream, number)

    return (
        points.writeStream.foreachBatch(write).queryName(stream).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FILE_INTERVAL})).start()
    )
