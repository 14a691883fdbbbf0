"""Patterns of any length on streams, with the matches that tables have.

Rows wait in the state until their slice of event time is closed, in entries of bounded size (``windows.closed_rows``). A batch
then has whole slices, all later than those of batches before it. To these rows come the last rows of each key from
before, one fewer than the pattern has; that is all a match needs of its past, however far back the key's last row lies. The functions for
tables find the matches, and those that end in a new row are new. Matches and last rows are tables with a commit list, so a batch
that runs again leaves no trace.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from thermoflow.model import READING_ORDER
from thermoflow.operators.distributions import newest_per_key
from thermoflow.operators.sequences import Pattern, matches
from thermoflow.sinks.commits import CommittedTable
from thermoflow.sinks.points import FILE_INTERVAL
from thermoflow.streaming.windows import STATE_ROWS, closed_rows

MATCHES, LAST_ROWS = "matches", "last-rows"


def store_matches(
    df: DataFrame,
    pattern: Pattern,
    results: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    stream: str,
    keys: Sequence[str] = ("room_id", "source"),
    order_by: Sequence[str] = READING_ORDER,
    slice_width: str = "1 second",
    state_rows: int = STATE_ROWS,
    **trigger,
) -> StreamingQuery:
    """Store what ``results`` makes of new matches (as ``operators.sequences.matches`` gives them) below ``path``.

    Needs a watermark on the first order column; the last one is a unique whole number.
    """
    rows = closed_rows(df, slice_width, order_by[0], order_by[-1], state_rows)
    columns, last = df.columns, pattern.steps[-1]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found, tails = CommittedTable(spark, f"{path}/{MATCHES}"), CommittedTable(spark, f"{path}/{LAST_ROWS}")
        before = tails.listed()
        if before.streams.get(stream, -1) >= number:
            return
        # The batch is computed once; its rows are read twice.
        fresh = tails.staged(tails.stage(batch), batch.schema)
        both = fresh.withColumn("_new", F.lit(True))
        if before.folders:
            both = both.unionByName(tails.read(before).withColumn("_new", F.lit(False)))
        event = F.col(last.name) if last.times == 1 else F.element_at(last.name, -1)
        new = matches(both, pattern, keys, order_by).where(event["_new"])
        found.append(results(new), stream, number)
        if pattern.length > 1:
            kept = newest_per_key(both, pattern.length - 1, keys, order_by).select(*columns)
            tails.commit([tails.stage(kept)], kept.schema, remove=before.folders, stream=stream, batch=number)

    return (
        rows.writeStream.foreachBatch(write).queryName(stream).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FILE_INTERVAL})).start()
    )
