"""Mixing sources to target weights by a Pfair schedule.

The rows of each source are put in a random but fixed order and cut into blocks. A source of
weight ``w`` gets windows for its blocks: block ``k`` is released at slot ``floor(k / w)`` and due before slot
``ceil((k + 1) / w)``. In each slot the released block with the earliest deadline goes (ties: the source that comes first
by name). Then, at every slot, each source has had its share to within less than one block.

The windows come from the weights themselves, for all blocks: there is no period and no rounded weight. When a
source is used up in its ideal share, the weights of the others are scaled up from that moment (``placed``). So every row
is placed, and no source is ever a block or more from its ideal share.

At scale: places in a source come from counts of hash ranges of bounded size, so a source with most of
the rows is many ranges. Counts and weights of sources stay in a table, however many there are; the driver sees only those that
``targets`` names. The slots are worked out by one task from that table: it holds a few numbers for each source,
goes through the blocks (not the rows; about 5 seconds for a million blocks) and writes a table of
slots, ``RUN`` blocks of a source in a row, which the rows are joined with.

Null source: a source of its own. Sources without a target weight: they share the rest of 1 in
proportion to their rows (all weight is theirs if no target is given); weights that sum to more than 1 are scaled down. A weight
of 0 is not allowed, as its rows would never come. Repeated rows are placed one by one. Empty table: empty result.
Columns named ``block, slot, place, position`` in the input are replaced by the results.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from thermoflow.llm.common import map_arrow, read, written

BLOCK = 64
#: Slots that a row of ``schedule`` covers.
SLOTS = 1000
#: Blocks in a row of the table of slots.
RUN = 256
#: Ideal times this near to a whole slot count as being there (windows that shrink by it still all fit).
ROUNDING = 1e-6
#: Rows of a hash range, about.
RANGE = 4000
#: Exponent that turns row counts into the weights of the registered query.
TEMPERATURE = 0.5

_ADDED = ("block", "slot", "place", "position")


def _weighed(counts: DataFrame, targets: dict | None, exponent: float) -> DataFrame:
    """``counts`` (``of_name, rows``) with ``weight``, a positive number for each source."""
    if targets is None:
        return counts.withColumn("weight", F.pow("rows", F.lit(float(exponent))))
    kind = counts.schema["of_name"].dataType.simpleString()
    given = counts.sparkSession.createDataFrame(
        [(name, float(w)) for name, w in targets.items()], f"target {kind}, given double"
    )
    known = counts.join(given, F.col("of_name").eqNullSafe(F.col("target")), "left").drop("target")
    least, total, others, rows = known.agg(
        F.min("given"), F.coalesce(F.sum("given"), F.lit(0.0)), F.count_if(F.col("given").isNull()),
        F.sum(F.when(F.col("given").isNull(), F.col("rows"))),
    ).first()
    if least is not None and not least > 0:
        raise ValueError("weights must be positive")
    rest = max(0.0, 1 - total)
    if others and rest == 0:
        some = [r[0] for r in known.where("given IS NULL").select("of_name").limit(5).collect()]
        raise ValueError(f"no weight is left for {others} sources, as {sorted(map(str, some))}")
    return known.select(
        "of_name", "rows", F.coalesce("given", F.lit(rest) * F.col("rows") / F.lit(rows or 1)).alias("weight")
    )


def parts_of(weights: list[float], slots: int) -> list[int]:
    """Whole numbers of slots, one at least, that sum to ``slots``: each next slot goes where most is owed."""
    total = sum(weights)
    exact = [w / total * slots for w in weights]
    parts = [max(1, math.floor(x)) for x in exact]
    while (short := slots - sum(parts)) != 0:
        step = 1 if short > 0 else -1
        i = max((i for i in range(len(parts)) if step > 0 or parts[i] > 1), key=lambda i: (step * (exact[i] - parts[i]), -i))
        parts[i] += step
    return parts


def placed(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int]]:
    """For slot 0, 1, ...: the source whose block goes there, and the number of the block.

    The ideal shares grow evenly with the weights until the blocks of a source are used up in them; from that
    moment on the others share its part. Block ``k`` of a source is released in the slot in which its ideal
    share passes ``k`` and due by the slot in which it reaches ``k + 1``. The windows of ``n`` blocks that lie in a
    span have ``n`` slots of ideal work in it, so earliest deadline first meets all deadlines.
    """
    w, n = np.asarray(weights, dtype=float), np.asarray(blocks, dtype=float)
    # Ideal time at which a source is used up, for the sources in the order of blocks / weight.
    order = np.argsort(n / w, kind="stable")
    levels = (n / w)[order]
    active = np.cumsum(w[order][::-1])[::-1]
    times = np.cumsum(np.diff(levels, prepend=0.0) * active).tolist()
    levels, rates = levels.tolist(), active.tolist()
    w, at, starts = w.tolist(), [0] * len(w), [0] * len(w)

    def time(i: int, k: int) -> float:
        level, j = k / w[i], at[i]
        while j + 1 < len(levels) and levels[j] < level:
            # Few steps as a rule; many are skipped at once.
            j = j + 1 if levels[j + 1] >= level else bisect.bisect_left(levels, level, j + 1, len(levels) - 1)
        at[i] = j
        before, start = (levels[j - 1], times[j - 1]) if j else (0.0, 0.0)
        return start + (level - before) * rates[j]

    released = [(0, i, 0) for i in range(len(w))]
    ready: list[tuple[int, int, int]] = []
    for slot in range(int(n.sum())):
        while released and released[0][0] <= slot:
            _, i, k = heapq.heappop(released)
            end = time(i, k + 1)
            heapq.heappush(ready, (math.ceil(end - ROUNDING), i, k))
            # The next block is released when the ideal share has passed this one.
            starts[i] = math.floor(end + ROUNDING)
        _, i, k = heapq.heappop(ready)
        yield i, k
        if k + 1 < blocks[i]:
            heapq.heappush(released, (starts[i], i, k + 1))


def period(parts: list[int]) -> list[list[int]]:
    """For each source, the slots of its blocks in one period of ``sum(parts)`` slots."""
    out: list[list[int]] = [[] for _ in parts]
    for slot, (i, _) in enumerate(placed(parts, parts)):
        out[i].append(slot)
    return out


def schedule(blocks: dict, weights: dict, slots: int = SLOTS) -> list[tuple]:
    """Rows ``source, first_block, end_block, first_slot, slots, offsets``: where runs of blocks go.

    Block ``first_block + n`` goes to ``first_slot + offsets[n]``; a run is what a source has in ``slots`` slots.
    """
    names = sorted((n for n in blocks if blocks[n] > 0), key=lambda n: (n is not None, str(n)))
    runs: dict[tuple, list[int]] = {}
    first: dict[tuple, int] = {}
    for slot, (i, k) in enumerate(placed([blocks[n] for n in names], [weights[n] for n in names])):
        run = (slot // slots, i)
        first.setdefault(run, k)
        runs.setdefault(run, []).append(slot % slots)
    return [
        (names[i], first[turn, i], first[turn, i] + len(offsets), turn * slots, slots, offsets)
        for (turn, i), offsets in runs.items()
    ]


def _slots(weighed: DataFrame, block: int) -> DataFrame:
    """``of_name, run, slots``: the slots of blocks ``run * RUN, run * RUN + 1, ...`` of a source."""
    sources = weighed.select(
        "of_name", F.expr(f"(rows + {block - 1}) div {block}").alias("blocks"), "weight"
    ).repartition(1).sortWithinPartitions("of_name")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        names, blocks = table.column("of_name").combine_chunks(), table.column("blocks").to_pylist()
        had: dict[int, list[int]] = {}
        out: list[tuple[int, int, list[int]]] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                names.take(pa.array([i for i, _, _ in out], pa.int64())), pa.array([r for _, r, _ in out], pa.int64()),
                pa.array([x for _, _, x in out], pa.list_(pa.int64())),
            ], names=["of_name", "run", "slots"])

        for slot, (i, k) in enumerate(placed(blocks, table.column("weight").to_pylist())):
            had.setdefault(i, []).append(slot)
            if k % RUN == RUN - 1 or k + 1 == blocks[i]:
                out.append((i, k // RUN, had.pop(i)))
                if len(out) == 4096:
                    yield batch()
                    out.clear()
        yield batch()

    kind = weighed.schema["of_name"].dataType.simpleString()
    return written(map_arrow(sources, runs, f"of_name {kind}, run bigint, slots array<bigint>"), "mixture-slots")


def _ranked(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` (``row, name, hash, tie``) with ``rank``: their place in their source, from 0."""
    sizes = counts.select("of_name", F.expr(f"(rows + {RANGE - 1}) div {RANGE}").alias("ranges"))
    # The hash has 63 bits; the high ones choose the range, so ranges are in the order of hashes.
    ranged = rows.join(sizes, F.col("name").eqNullSafe(F.col("of_name"))).withColumn(
        "range", F.shiftright(F.shiftright("hash", 32) * F.col("ranges"), 31)
    ).drop("of_name", "ranges")
    before = (
        ranged.groupBy(F.col("name").alias("of_name"), F.col("range").alias("of_range")).count()
        .withColumn("before", F.sum("count").over(
            Window.partitionBy("of_name").orderBy("of_range").rowsBetween(Window.unboundedPreceding, -1)
        )).drop("count")
    )
    placed = ranged.join(before, F.col("name").eqNullSafe(F.col("of_name")) & (F.col("range") == F.col("of_range")))
    nth = F.row_number().over(Window.partitionBy("name", "range").orderBy("hash", "tie"))
    return placed.select("row", "name", (F.coalesce("before", F.lit(0)) + nth - 1).alias("rank"))


def mix(df: DataFrame, targets: dict | None = None, source: str = "source", order: tuple[str, ...] = ("doc_id",),
        block: int = BLOCK, exponent: float = TEMPERATURE) -> DataFrame:
    """The input with ``block`` and ``place`` (of a row in its source), ``slot`` (of the block), ``position``.

    Rows in order of ``position`` are the mixture. ``targets`` maps sources to weights; without it,
    weights are in proportion to the row counts to the power of ``exponent``. Rows of a source come
    in the order of a hash of the ``order`` columns.
    """
    counts = written(df.groupBy(F.col(source).alias("of_name")).agg(F.count(F.lit(1)).alias("rows")), "mixture-counts")
    table = _slots(_weighed(counts, targets, exponent), block)
    rows = df.select(
        F.struct(*df.columns).alias("row"), F.col(source).alias("name"),
        F.shiftrightunsigned(F.xxhash64(*order), 1).alias("hash"),
        F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]).alias("tie"),
    )
    ranked = _ranked(rows, counts).withColumns({
        "block": F.call_function("div", "rank", F.lit(block)), "place": F.col("rank") % block,
    })
    run = F.call_function("div", F.col("block"), F.lit(RUN))
    slot = F.get("slots", (F.col("block") % RUN).cast("int"))
    return (
        ranked.join(table, F.col("name").eqNullSafe(F.col("of_name")) & (run == F.col("run")))
        .withColumn("slot", slot).withColumn("position", F.col("slot") * block + F.col("place"))
        .select(*[F.col("row")[c].alias(c) for c in df.columns if c not in _ADDED], *_ADDED)
    )


def op10_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(read(spark, folder, "documents").select("doc_id", "source"))
