"""Documents that contain passages of a benchmark, also with some words replaced.

Texts are compared by windows of twelve words. A window is cut into four blocks of three; each of
six fixed masks keeps two blocks and ignores the other six words. If two windows
differ in at most two words, at least two blocks are untouched, so at least one mask gives both
the same hash: joining the masked hashes of benchmark and documents finds every such
pair. Around each hit the two windows are compared word by word, and pairs with ten or more
equal words are overlaps.

Benchmark items shorter than a window, but of at least ``SHORTEST`` words, are looked for as they are, without
replacements; shorter ones are ignored (they say nothing). Words are runs of letters and
digits, in lower case.

At scale: only hashes that a filter of fixed size (made from the benchmark) lets through leave the scan; the
exact join follows. Equal windows of the benchmark are one. A passage that very many documents
share makes one side of the join hot, which Spark may split.

Null texts: no words. Null ids of documents: reported as null. Null ids of items: never reported, as they name nothing.
Repeated rows: reported once for each id. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermoflow.llm.batches import Words, mixed, slices, window_hashes
from thermoflow.llm.common import map_arrow, read, text_of, written
from thermoflow.llm.filters import Membership, membership

WINDOW, BLOCK = 12, 3
#: Words of a window that must be equal.
EQUAL = 10
SHORTEST = 6

_MASKS = list(combinations(range(WINDOW // BLOCK), 2))


def _normal(text: str = "text"):
    return F.regexp_replace(F.lower(text_of(text)), r"[^\p{L}\p{N}]+", " ")


def _masked(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Hashes of all windows of ``size`` words, one array for each mask (short windows have one, which keeps all)."""
    if len(hashes) < size:
        return
    if size < WINDOW:
        yield mixed(window_hashes(hashes, size) + np.uint64(size))
        return
    blocks = window_hashes(hashes, BLOCK)
    count = len(hashes) - WINDOW + 1
    for number, (a, b) in enumerate(_MASKS):
        first, second = blocks[a * BLOCK: a * BLOCK + count], blocks[b * BLOCK: b * BLOCK + count]
        yield mixed(first * np.uint64(0xD6E8FEB86659FD93) + second + np.uint64(1000 + number))


def _windows(batch: pa.RecordBatch, sizes: list[int], wanted: Membership | None, own_size: bool) -> pa.RecordBatch:
    """Rows ``id, at, size, seed, words`` of the windows whose masked hash is wanted (None: all).

    With ``own_size`` a text shorter than a window has one window, itself.
    """
    words = Words(batch.column("text"))
    out = []
    lengths = np.diff(words.first)
    for size in sizes:
        for seeds in _masked(words.hashes, size):
            at = np.arange(len(seeds)) if wanted is None else np.flatnonzero(wanted.might_have(seeds))
            text = np.searchsorted(words.first, at, side="right") - 1
            inside = at + size <= words.first[text + 1]
            if own_size and size < WINDOW:
                inside &= lengths[text] == size
            at, text = at[inside], text[inside]
            out.append((text, at, np.full(len(at), size), seeds[at]))
    text, at, size, seeds = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 4
    # Short windows are padded with zeros.
    places = np.arange(WINDOW)
    taken = np.minimum(at[:, None] + places, max(len(words.hashes) - 1, 0))
    values = np.where(places < size[:, None], words.hashes[taken] if len(words.hashes) else np.uint64(0), np.uint64(0))
    return pa.RecordBatch.from_arrays(
        [batch.column("id").take(pa.array(text)), pa.array((at - words.first[text]).astype(np.int32)),
         pa.array(size.astype(np.int32)), pa.array(seeds.astype(np.uint64).view(np.int64)),
         pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * WINDOW, pa.array(values.view(np.int64).ravel()))],
        names=["id", "at", "size", "seed", "words"],
    )


_SCHEMA = "id bigint, at int, size int, seed bigint, words array<bigint>"


def overlaps(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
             text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Verified pairs ``doc_id, at, window`` and, for each window of the benchmark, its ``item_id``."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("id"), _normal(text).alias("text")).where("id IS NOT NULL")

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 19):
            yield _windows(batch, list(range(SHORTEST, WINDOW + 1)), None, True)

    rows = written(map_arrow(items, of_items, _SCHEMA), "benchmark-windows")
    rows = rows.withColumn("window", F.xxhash64("size", "words"))
    seeds = written(rows.select("seed", "window", "size", F.col("words").alias("b")).distinct(), "benchmark-seeds")
    owners = rows.select("window", F.col("id").alias("item_id")).distinct()
    sizes = sorted(r[0] for r in seeds.select("size").distinct().collect())
    sent = documents.sparkSession.sparkContext.broadcast(membership(seeds, F.col("seed"), 64))

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            yield _windows(batch, sizes, sent.value, False)

    texts = documents.select(F.col(doc_id).cast("bigint").alias("id"), _normal(text).alias("text"))
    found = map_arrow(texts, of_documents, _SCHEMA)
    equal = sum((F.get("words", F.lit(i)) == F.get("b", F.lit(i))).cast("int") for i in range(WINDOW))
    enough = F.when(F.col("size") == WINDOW, F.lit(EQUAL)).otherwise(F.lit(WINDOW))
    pairs = found.join(seeds, ["seed", "size"]).where(equal >= enough).select(
        F.col("id").alias("doc_id"), "at", "size", "window"
    ).distinct()
    return pairs, owners


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The ids of the documents with an overlap, each once."""
    return overlaps(documents, benchmark)[0].select("doc_id").distinct()


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and item that overlap: how many windows, and the words they cover."""
    pairs, owners = overlaps(documents, benchmark)
    return pairs.join(owners, "window").groupBy("doc_id", "item_id").agg(
        F.countDistinct("at").alias("n_windows"), F.min("at").cast("bigint").alias("first_word"),
        F.max(F.col("at") + F.col("size")).cast("bigint").alias("end_word"),
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def _sql_keys(name: str) -> str:
    """The six masked keys of the windows in ``t``."""
    return " UNION ALL ".join(
        f"SELECT *, '{a}{b}:' || array_to_string(t[{a * BLOCK + 1}:{a * BLOCK + BLOCK}], ' ') || '/' || "
        f"array_to_string(t[{b * BLOCK + 1}:{b * BLOCK + BLOCK}], ' ') AS k FROM {name}"
        for a, b in _MASKS
    )


#: For benchmarks whose items all have a whole window, as the given ones do.
SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS ws FROM benchmark),
dw AS (SELECT doc_id, i - 1 AS p, ws[i:i + {WINDOW - 1}] AS t FROM (SELECT *, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
bw AS (SELECT DISTINCT item_id, ws[i:i + {WINDOW - 1}] AS t FROM (SELECT *, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM b)),
dk AS ({_sql_keys('dw')}), bk AS ({_sql_keys('bw')}),
pairs AS (
  SELECT DISTINCT doc_id, p, item_id FROM dk JOIN bk USING (k)
  WHERE list_sum(list_transform(range(1, {WINDOW + 1}), lambda i: (dk.t[i] = bk.t[i])::INTEGER)) >= {EQUAL})
SELECT doc_id, item_id, count(*) AS n_windows, min(p)::BIGINT AS first_word, (max(p) + {WINDOW})::BIGINT AS end_word
FROM pairs GROUP BY doc_id, item_id
"""
