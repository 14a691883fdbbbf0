"""Repeated passages: blocks of texts looked up among all earlier texts.

Every run of ``window`` words has an *anchor* chosen by its words alone: the eight-word
run in it with the least hash. Neighbouring windows mostly share their anchor, and the stretch
of words under one anchor is a *block*. Blocks, by anchor and content, are the reference
that texts are compared with, by one look-up per block, in place of a greedy Lempel-Ziv parse: blocks are not
joined into factors, and no longest match is computed. Some blocks
no earlier text has as a whole, though an earlier one has their anchor. There, and only there, are
windows checked one by one. So the result is exact: a window is removed if
and only if an earlier text has the same words, whatever block borders fall where.

At scale: look-ups are aggregations by (anchor, block) to the smallest id, which collapse
copies before the shuffle, and joins that Spark may split; about one row per twenty words is shuffled, not one
per word. Windows to be checked are chosen by a filter of fixed size. The texts are read
three times and shuffled once, with the spans to remove.

*Earlier* means a smaller id. Repeated rows and equal ids are not earlier than each other. A null id is
neither earlier nor later than any other, so such texts stay whole. Null text: no words. Texts of fewer words than a
window stay whole. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermoflow.llm.batches import BASE, Words, mixed, powers, slices
from thermoflow.llm.common import map_arrow, read, text_of, written
from thermoflow.llm.filters import membership

WINDOW = 50
ANCHOR = 8

_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class _Runs:
    """Hashes of any run of words in a sequence, from running sums."""

    def __init__(self, hashes: np.ndarray):
        self._sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(len(hashes)), out=self._sums[1:])
        self._shift = powers(len(hashes), _INVERSE)

    def hash(self, starts: np.ndarray, lengths) -> np.ndarray:
        value = (self._sums[starts + lengths] - self._sums[starts]) * self._shift[starts]
        return mixed(value + np.asarray(lengths).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the first least value of the next ``width`` is."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        have += step
    return at


class _Blocks:
    """The blocks of a slice of texts: the text, first window, number of windows, anchor and content."""

    def __init__(self, words: Words, window: int):
        self.window = window
        self.runs = _Runs(words.hashes)
        sizes = np.diff(words.first)
        fits = np.maximum(sizes - window + 1, 0)
        total = int(fits.sum())
        self.text = self.first = self.count = np.zeros(0, dtype=np.int64)
        self.anchor = self.content = np.zeros(0, dtype=np.uint64)
        self.origin = words.first
        if total == 0:
            return
        grams = self.runs.hash(np.arange(len(words.hashes) - ANCHOR + 1), ANCHOR)
        least = _least(grams, window - ANCHOR + 1)
        before = np.cumsum(fits) - fits
        starts = np.arange(total) + np.repeat(words.first[:-1] - before, fits)
        at = least[starts]
        opens = np.ones(total, dtype=bool)
        opens[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        opens = np.flatnonzero(opens)
        self.first = starts[opens]
        self.count = np.diff(np.append(opens, total))
        self.anchor = grams[at[opens]]
        self.content = self.runs.hash(self.first, self.count + window - 1)
        self.text = np.repeat(np.arange(len(sizes)), fits)[opens]

    def windows(self, chosen: np.ndarray):
        """The windows of some blocks: index of the block, place, hash."""
        counts = self.count[chosen]
        block = np.repeat(chosen, counts)
        starts = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts) + self.first[block]
        return block, starts, self.runs.hash(starts, self.window)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _reference(rows: DataFrame, content: str) -> DataFrame:
    """For each anchor and content, the smallest id that has it."""
    return rows.groupBy("anchor", content).agg(F.min("doc_id").alias("first_doc"))


def repeated_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs of windows to remove: ``doc_id, text_key, first, windows``. ``texts``: doc_id, text_key, text."""
    texts = texts.where(F.col("doc_id").isNotNull())
    key = "doc_id bigint, text_key bigint"

    def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            blocks = _Blocks(Words(batch.column("text")), window)
            owner = pa.array(blocks.text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("text_key").take(owner),
                 pa.array((blocks.first - blocks.origin[blocks.text]).astype(np.int32)),
                 pa.array(blocks.count.astype(np.int32)), _signed(blocks.anchor), _signed(blocks.content)],
                names=["doc_id", "text_key", "first", "windows", "anchor", "content"],
            )

    blocks = written(
        map_arrow(texts, block_rows, f"{key}, first int, windows int, anchor bigint, content bigint"), "blocks"
    )
    # Anchors that more than one document has. Both steps collapse copies before they shuffle.
    reference = _reference(blocks, "content")
    shared = written(
        reference.join(
            blocks.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
            .where("a < b").select("anchor"), "anchor", "left_semi"
        ), "shared-blocks",
    )
    # Blocks that an earlier document has as they are.
    whole = blocks.join(shared, ["anchor", "content"]).where("first_doc < doc_id").select(
        "doc_id", "text_key", "first", "windows"
    )
    # Blocks that are the first of their kind, under an anchor with other blocks.
    open_anchors = shared.groupBy("anchor").agg(
        F.min("content").alias("a"), F.max("content").alias("b")
    ).where("a < b").select("anchor")
    ends = shared.join(open_anchors, "anchor", "left_semi")
    wanted = membership(ends, F.expr("anchor ^ content ^ first_doc"))
    sent = texts.sparkSession.sparkContext.broadcast(wanted)

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            blocks = _Blocks(Words(batch.column("text")), window)
            docs = batch.column("doc_id").to_numpy().astype(np.int64).view(np.uint64)
            chosen = np.flatnonzero(sent.value.might_have(blocks.anchor ^ blocks.content ^ docs[blocks.text]))
            block, starts, hashes = blocks.windows(chosen)
            owner = pa.array(blocks.text[block])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("text_key").take(owner),
                 pa.array((starts - blocks.origin[blocks.text[block]]).astype(np.int32)),
                 _signed(blocks.anchor[block]), _signed(hashes)],
                names=["doc_id", "text_key", "first", "anchor", "content"],
            )

    windows = written(
        map_arrow(texts, window_rows, f"{key}, first int, anchor bigint, content bigint"), "windows"
    )
    repeated = written(
        windows.groupBy("anchor", "content").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .where("first_doc < last_doc").drop("last_doc"), "repeated-windows",
    )
    kept = texts.sparkSession.sparkContext.broadcast(membership(repeated, F.expr("anchor ^ content")))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("anchor").to_numpy() ^ batch.column("content").to_numpy()
            yield batch.filter(pa.array(kept.value.might_have(both.view(np.uint64))))

    single = map_arrow(windows, likely, windows.schema).join(repeated, ["anchor", "content"]).where(
        "first_doc < doc_id"
    ).select("doc_id", "text_key", "first", F.lit(1).alias("windows"))
    return whole.unionByName(single)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """A row per document: ``doc_id, n_words, n_removed, kept_text`` (the kept words, one blank between)."""
    if window < ANCHOR:
        raise ValueError(f"a window has {ANCHOR} words at least")
    texts = df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_of(text).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    # The spans of one text are no more than its own words.
    spans = repeated_spans(texts, window).groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("first", "windows")).alias("spans")
    )
    joined = texts.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans.first", "spans.windows")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, removed, kept = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "first", "windows")))
            for body, firsts, lengths in rows:
                words = body.encode().split()
                counts.append(len(words))
                if not firsts:
                    removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                firsts, lengths = np.array(firsts), np.array(lengths)
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(depth, firsts, 1)
                np.add.at(depth, firsts + lengths + window - 1, -1)
                stays = np.cumsum(depth[:-1]) == 0
                removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(compress(words, stays.tolist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return map_arrow(joined, remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+') AS ws FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS k
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
repeated AS (SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
covered AS (
  SELECT words.r, word, p, max(i) OVER (
    PARTITION BY words.r ORDER BY p ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN repeated ON repeated.r = words.r AND i = p)
SELECT doc_id, count(p) AS n_words, coalesce(sum(gone::BIGINT), 0)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM w LEFT JOIN covered USING (r) GROUP BY r, doc_id
"""
