"""Near duplicates by the Jaccard similarity of five-word runs.

Each text gets minhash signatures, cut into trees. A tree is a trie of signature prefixes:
texts under the same node agree in that prefix. Texts are compared under their
longest prefixes first; then prefixes are shortened until a pair at the wanted similarity meets in some
tree with the wanted probability (``RECALL``). Every candidate is verified exactly.

How hot groups are handled. Texts with the same set of runs are one class before
anything else (a partial aggregation). Under a node, texts are held against the
least of them, not all against all; only where a node of the shortened tries still has texts of several
groups, pairs across groups are formed. A compact sketch drops pairs that are clearly below the similarity. What is left are candidate
groups; their texts are verified exactly, all pairs, in tiles of bounded size that
give counts per text and no pairs. So links between different texts are all counted, and copies add
to the counts by their number.

Words are runs of anything but blank, tab, line feed, vertical tab, form feed and return,
in lower case. A text with fewer than five words is one run. Null or empty text: no
runs, no links, a class of its own. Null id: likewise, the class is null. Rows with equal ids count as
one document with copies. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermoflow.llm.batches import Words, mixed, slices
from thermoflow.llm.common import map_arrow, read, ship, text_of, written
from thermoflow.llm.components import components
from thermoflow.llm.filters import membership
from thermoflow.llm.substring_dedup import _Runs

SIZE = 5
SIMILARITY = 0.8
TREES, LONGEST = 16, 6
RECALL = 0.999
#: Texts on either side of a tile of exact comparisons.
TILE = 128
#: Fields of two bits in the sketch (one for each minhash) of which a pair must share this many: at the
#: similarity wanted about 82 of 96 agree, with a standard deviation of 3.5.
SKETCH_SHARED = 68

_SIGNATURE = TREES * LONGEST
_SEEDS = mixed(np.arange(1, _SIGNATURE + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_LOW = 0x5555555555555555


def prefix_length(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The longest prefix at which a pair meets in some tree often enough."""
    for length in range(LONGEST, 1, -1):
        if 1 - (1 - similarity**length) ** TREES >= recall:
            return length
    return 1


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of all texts, each once per text and sorted, and where each text's begin."""
    words = Words(texts)
    runs = _Runs(words.hashes)
    out, firsts = [], [0]
    whole = runs.hash(np.arange(max(len(words.hashes) - SIZE + 1, 0)), SIZE)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= SIZE:
            h = np.sort(whole[a: b - SIZE + 1])
            out.append(h[np.append(True, h[1:] != h[:-1])])
        elif b > a:
            out.append(runs.hash(np.array([a]), b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        firsts.append(firsts[-1] + len(out[-1]))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64), np.array(firsts)


def _signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minhashes: one row per text (none without runs), one column per seed."""
    out = np.empty((_SIGNATURE, len(starts)), dtype=np.uint64)
    buffer = np.empty_like(hashes)
    for k, seed in enumerate(_SEEDS):
        np.multiply(hashes, seed, out=buffer)
        out[k] = np.minimum.reduceat(buffer, starts)
    return mixed(out).T


def _prefix_keys(signatures: np.ndarray, length: int) -> np.ndarray:
    """A hash of the first ``length`` minhashes in each tree."""
    trees = signatures.reshape(len(signatures), TREES, LONGEST)
    key = np.broadcast_to(mixed(np.arange(1, TREES + 1, dtype=np.uint64)), trees.shape[:2]).copy()
    for i in range(length):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + trees[:, :, i])
    return key


def _sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of every minhash, in 64-bit numbers."""
    fields = (signatures & np.uint64(3)).reshape(len(signatures), _SIGNATURE // 32, 32)
    shifts = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(fields << shifts, axis=2)


_SKETCH = [f"s{i}" for i in range(_SIGNATURE // 32)]


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], flat)


def signatures(texts: DataFrame, short: int) -> DataFrame:
    """For each text: digests of its set of runs, keys of the long and short prefixes, the sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            hashes, firsts = _shingles(batch.column("text"))
            sizes = np.diff(firsts)
            some = np.flatnonzero(sizes)
            columns = [batch.column("doc_id"), pa.array(sizes.astype(np.int32))]
            names = ["doc_id", "runs"]
            digests = np.zeros((2, len(sizes)), dtype=np.uint64)
            where = np.full(len(sizes), -1)
            where[some] = np.arange(len(some))
            take = pa.array(where, mask=where < 0)
            if len(some):
                starts = firsts[:-1][some]
                digests[0, some] = np.add.reduceat(mixed(hashes), starts)
                digests[1, some] = np.add.reduceat(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
                signed = _signatures(hashes, starts)
            else:
                signed = np.zeros((0, _SIGNATURE), dtype=np.uint64)
            columns += [pa.array(d.view(np.int64)) for d in digests]
            names += ["set_a", "set_b"]
            columns += [_lists(_prefix_keys(signed, n)).take(take) for n in (LONGEST, short)]
            names += ["long_keys", "short_keys"]
            sketch = _sketches(signed)
            columns += [pa.array(np.ascontiguousarray(sketch[:, i]).view(np.int64)).take(take) for i in range(len(_SKETCH))]
            names += _SKETCH
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = ", ".join(f"{s} bigint" for s in _SKETCH)
    return map_arrow(
        texts, sign, "doc_id bigint, runs int, set_a bigint, set_b bigint, "
        f"long_keys array<bigint>, short_keys array<bigint>, {kinds}"
    )


def _similar(a: str, b: str) -> Column:
    """Whether the sketches of two rows share enough fields."""
    apart = F.lit(0)
    for s in _SKETCH:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        apart += F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(_LOW)))
    return apart <= _SIGNATURE - SKETCH_SHARED


def _candidates(reps: DataFrame) -> DataFrame:
    """``node, component``: groups of classes that may be similar, through long, then short prefixes."""
    sketches = reps.select("rep", *_SKETCH)

    def checked(pairs: DataFrame) -> DataFrame:
        return (
            pairs.where("a <> b").distinct().alias("p")
            .join(sketches.alias("x"), F.col("p.a") == F.col("x.rep"))
            .join(sketches.alias("y"), F.col("p.b") == F.col("y.rep"))
            .where(_similar("x", "y")).select("p.a", "p.b")
        )

    long = reps.select(F.explode("long_keys").alias("key"), "rep")
    leaders = long.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last").drop("last")
    near = written(checked(long.join(leaders, "key").select(F.col("rep").alias("a"), "b")), "long-links")
    groups = components(near)
    grouped = written(
        reps.join(groups, F.col("rep") == F.col("node"), "left").select(
            "rep", "short_keys", F.coalesce("component", "rep").alias("component")
        ), "long-groups",
    )
    short = grouped.select(F.explode("short_keys").alias("key"), "rep", "component")
    mixed_keys = short.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b")
    ).where("a < b").select("key")
    open_rows = written(
        short.join(mixed_keys, "key").join(sketches, "rep"), "short-rows"
    )
    across = open_rows.alias("x").join(
        open_rows.alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & _similar("x", "y"),
    ).select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"))
    return components(near.unionByName(across))


def _verified_tile(sets: list[np.ndarray], blocks: np.ndarray, similarity: float) -> np.ndarray:
    """Which members of a tile are linked. Tiles of two blocks have links across only."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    opens = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(opens) - 1
    often = np.bincount(column)[column] > 1
    owner, column = owner[often], column[often]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    shared = np.zeros((n, n), dtype=np.float32)
    width = 4096
    cuts = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else -1) + width + 1, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            have = np.zeros((n, width), dtype=np.float32)
            have[owner[a:b], column[a:b] - k * width] = 1
            shared += have @ have.T
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= similarity * union - 1e-9
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each member, the least member it is connected to."""
    n = len(linked)
    root = np.arange(n)
    while True:
        near = np.where(linked, root[None, :], n).min(axis=1)
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(texts: DataFrame, reps: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """``doc_id, links, root``: verified links of each class with others, by tile."""
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members = written(
        groups.join(sizes, "component").join(reps.select("rep", "copies"), F.col("node") == F.col("rep"))
        .select(F.col("node").alias("doc_id"), "component", "copies",
                F.ceil(F.col("members") / TILE).cast("int").alias("blocks")), "members",
    )
    spark = texts.sparkSession
    wanted = spark.sparkContext.broadcast(membership(members, F.xxhash64("doc_id")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            hit = wanted.value.might_have(batch.column("key").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(hit))
            if batch.num_rows:
                hashes, firsts = _shingles(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([hashes[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:])], pa.binary())],
                    names=["doc_id", "runs"],
                )

    keyed = texts.where(F.col("doc_id").isNotNull()).withColumn("key", F.xxhash64("doc_id"))
    tiles = (
        map_arrow(keyed, sets, "doc_id bigint, runs binary").join(members, "doc_id")
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "doc_id", "copies", "block", "runs")
    )

    def verify(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("doc_id", "runs", "copies", "block"))))
        rows = [r for k, r in enumerate(rows) if r[1] and (k == 0 or rows[k - 1][0] != r[0])]
        docs = np.array([r[0] for r in rows], dtype=np.int64)
        if len(docs) < 2:
            return pa.table({"doc_id": docs[:0], "links": docs[:0], "root": docs[:0]})
        linked = _verified_tile([np.frombuffer(r[1], dtype=np.uint64) for r in rows],
                                np.array([r[3] for r in rows]), similarity)
        copies = np.array([r[2] for r in rows], dtype=np.int64)
        some = linked.any(axis=1)
        return pa.table({
            "doc_id": docs[some], "links": (linked @ copies)[some], "root": docs[_roots(linked)][some],
        })

    ship(spark)
    return written(
        tiles.groupBy("component", "i", "j").applyInArrow(verify, "doc_id bigint, links bigint, root bigint"), "links"
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    recall: float = RECALL) -> DataFrame:
    """A row per document: ``doc_id, class_id`` (the least id of all connected with it) and ``n_links``."""
    texts = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.lower(text_of(text)).alias("text"))
    signed = written(signatures(texts, prefix_length(similarity, recall)), "signatures")
    known = signed.where("runs > 0 AND doc_id IS NOT NULL")
    reps = written(
        known.groupBy("set_a", "set_b").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "long_keys", "short_keys", *_SKETCH)).alias("least"),
        ).select("set_a", "set_b", "copies", F.col("least.doc_id").alias("rep"), "least.long_keys", "least.short_keys",
                 *[f"least.{s}" for s in _SKETCH]), "classes",
    )
    links = _links(texts, reps, _candidates(reps), similarity)
    classes = components(links.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("doc_id").agg(F.sum("links").alias("links"))
    found = (
        reps.select("set_a", "set_b", "copies", "rep")
        .join(classes, F.col("rep") == F.col("node"), "left")
        .join(counts, F.col("rep") == F.col("doc_id"), "left")
        .select("set_a", "set_b", F.coalesce("component", "rep").alias("class_id"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    linked = known.select("doc_id", "set_a", "set_b").join(found, ["set_a", "set_b"], "left").select(
        "doc_id", "class_id", "n_links"
    )
    alone = signed.where("runs = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")
    )
    return linked.unionByName(alone)


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents").select("doc_id", "text"))


SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\x0b\f\r]+') AS ws FROM documents),
runs AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {SIZE - 1}], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {SIZE - 1}, least(len(ws), 1)) + 1)) AS i FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM runs x JOIN runs y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE c >= {SIMILARITY} * (p.n + q.n - c) - 1e-9),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (SELECT a, least(a, min(b)) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN classes ON classes.a = doc_id LEFT JOIN counts ON counts.a = doc_id
"""
