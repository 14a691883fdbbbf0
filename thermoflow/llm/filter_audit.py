"""How five filters interact: what each removes, in every order they can be applied in.

Filters A to D look at one document (few words, few distinct words, many capitals, odd
symbols); E removes texts that a smaller id has too, anywhere in the table.

E starts with a prepass. Each text adds one to two cells of a counting Bloom sketch; every task's partial aggregate is a sketch of
its rows, and the sketches are merged by adding them up. A text with a cell of count one is nowhere else, so it is cleared. Only
texts whose two cells were both met again are shuffled, grouped by the whole text, and give their least id. What goes back to the documents is
a row of numbers for each hash; texts of different content under one hash are told apart by the text.

A document's failures are a mask of five bits. Counts of documents by part and mask are all that is kept of them: at most 32 rows a part, added up
before they are shuffled. From them follows, for each set of filters, how many documents pass it,
and from that every figure of all 120 orders.

At scale: two scans of the texts, one shuffle of possible repeats. A hot text is one row per task after
the partial aggregate. The sketch has about 16 cells a text but at most 2**``filters.MOST_BITS`` (16 MB sent as bits); beyond
that it is fuller and clears fewer texts, which costs shuffle and changes no result.

Null text: empty. Null part: empty string. Null ids: never fail E nor make others fail, and have no labels. Rows that repeat an id are counted one by one; with
one text they don't fail E by each other, as no id is smaller. Ids labelled twice: the higher label counts. Empty tables give no part, so no
row. Other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermoflow.llm.common import read, ship, text_of, words_of, written
from thermoflow.llm.filters import LEAST_BITS, MOST_BITS, Membership

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT, SYMBOLS = 200, 50, 3, "#$%&*|"
CELLS_PER_TEXT = 16
#: Documents, of these the good ones and the toxic ones.
_COUNTS = ("docs", "good", "toxic")


def own_failures(text: Column) -> Column:
    """The bits of A to D."""
    words = words_of(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failures = (
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        100 * capitals.cast("bigint") > MAX_CAPITALS_PERCENT * F.length(text).cast("bigint"),
        text.rlike(f"[{SYMBOLS}]"),
    )
    mask = F.lit(0)
    for i, failed in enumerate(failures):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    return mask


def repeats_sketch(hashes: DataFrame, hash_: str, texts: int) -> Membership:
    """The cells of the merged counting sketch that were met more than once."""
    bits = min(max((CELLS_PER_TEXT * texts).bit_length(), LEAST_BITS), MOST_BITS)
    mask = F.lit((1 << bits) - 1)
    cells = hashes.select(F.explode(F.array_distinct(F.array(
        F.col(hash_).bitwiseAND(mask), F.shiftrightunsigned(hash_, 34).bitwiseAND(mask)
    ))).alias("cell"))
    met_again = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    set_bits = met_again.groupBy(F.shiftright("cell", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")
    ).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[set_bits.column("word").to_numpy()] = set_bits.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return Membership(words)


def least_ids(texts: DataFrame, judged: DataFrame) -> DataFrame:
    """``doc_id, hash`` of the documents whose text a smaller id has too (distinct). ``texts`` has ``doc_id, hash, text``."""
    spark = texts.sparkSession
    ship(spark)
    sketch = spark.sparkContext.broadcast(repeats_sketch(judged, "hash", judged.count()))

    @F.pandas_udf("boolean")
    def might_repeat(hashes: pd.Series) -> pd.Series:
        return pd.Series(sketch.value.might_have(hashes.to_numpy().view(np.uint64)))

    def by_text(rows: DataFrame) -> DataFrame:
        return rows.groupBy("hash", "text").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))

    minima = written(
        by_text(texts.where(might_repeat("hash"))).groupBy("hash").agg(
            F.count(F.lit(1)).alias("texts"), F.min("least").alias("least"), F.max("last").alias("last")
        ).where("texts > 1 OR least < last"), "least-ids",
    )
    alone = minima.where("texts = 1").select("hash", "least")
    repeats = judged.join(alone, "hash").where("doc_id > least").select("doc_id", "hash")
    shared = minima.where("texts > 1").select("hash")
    if not shared.isEmpty():
        # Different texts with one hash: these documents are judged by their text.
        rows = written(texts.join(shared, "hash"), "texts-of-one-hash")
        least = by_text(rows).where("least < last").select("hash", "text", "least")
        repeats = repeats.unionByName(rows.join(least, ["hash", "text"]).where("doc_id > least").select("doc_id", "hash"))
    return repeats.distinct()


def failure_counts(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``part, mask, docs, good, toxic``: documents by their failures, bit i for filter i."""
    body = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of(text).alias("text")
    ).withColumn("hash", fingerprint(F.col("text")))
    judged = written(body.select("doc_id", "part", "hash", own_failures(F.col("text")).alias("own")), "own-failures")
    repeats = least_ids(body.select("doc_id", "hash", "text"), judged).withColumn("repeats", F.lit(16))
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).where("good = 1 OR toxic = 1")
    return (
        judged.join(repeats, ["doc_id", "hash"], "left").join(known, "doc_id", "left")
        .withColumn("mask", F.col("own") + F.coalesce("repeats", F.lit(0)))
        .groupBy("part", "mask").agg(
            F.count(F.lit(1)).alias("docs"), *[F.sum(F.coalesce(c, F.lit(0)).cast("bigint")).alias(c) for c in _COUNTS[1:]]
        )
    )


def _steps() -> Column:
    """For each order and step: the set of filters before it and the bit of its own."""
    rows = []
    for order in ORDERS:
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            rows.append({"filter_order": order, "step": step, "before": before, "bit": bit})
            before |= bit
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, before: int, bit: int>>")


def _all_orders(bit: int, passing: Callable[[int], Column]) -> Column:
    """What a filter removes, summed over all orders: sets before it, times the orders that have them."""
    total = F.lit(0).cast("bigint")
    n = len(FILTERS)
    for before in (s for s in range(1 << n) if not s & bit):
        size = before.bit_count()
        total = total + F.lit(factorial(size) * factorial(n - 1 - size)) * (passing(before) - passing(before | bit))
    return total


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of ``failure_counts``: a row per part, order and step."""
    sets = 1 << len(FILTERS)
    passed = counts.withColumn("set", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(sets - 1)), lambda s: s.bitwiseAND(F.col("mask")) == 0
    )))
    sums = passed.groupBy("part", "set").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    # At most one entry for each set of filters.
    by_set = sums.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("set", F.struct(*_COUNTS)))).alias("by_set")
    )
    arrays = by_set.select("part", *[
        F.transform(F.sequence(F.lit(0), F.lit(sets - 1)), lambda s: F.coalesce(F.try_element_at("by_set", s)[c], F.lit(0))).alias(c)  # noqa: B023
        for c in _COUNTS
    ])
    arrays = arrays.withColumn("shapley", F.array(*[
        _all_orders(1 << i, lambda s: F.get("docs", F.lit(s))) for i in range(len(FILTERS))
    ]))
    at = arrays.withColumn("at", F.explode(_steps())).select("*", "at.*")
    after, others = F.col("before").bitwiseOR(F.col("bit")), F.lit(sets - 1).bitwiseXOR(F.col("bit"))
    lost = {c: F.get(c, F.col("before")) - F.get(c, after) for c in _COUNTS}
    return at.select(
        "part", "filter_order", "step", F.get("docs", after).alias("kept"), lost["docs"].alias("removed"),
        (F.get("docs", F.lit(0)) - F.get("docs", F.col("bit")) - lost["docs"]).alias("redundant"),
        (F.get("docs", others) - F.get("docs", F.lit(sets - 1))).alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"),
        F.get("shapley", F.bit_count(F.col("bit") - 1)).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return interactions(failure_counts(read(spark, folder, "documents"), read(spark, folder, "labels")))


SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^ \t\n\x0b\f\r]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
failed AS (
  SELECT doc_id, part, [len(w) < {MIN_WORDS}, 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS_PERCENT} * length(text),
    regexp_matches(text, '[{SYMBOLS}]'), coalesce(doc_id > least, false)] AS f
  FROM words),
known AS (SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic FROM labels GROUP BY 1),
masks AS (
  SELECT part, f, count(*) AS docs, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, i AS step, o[i] AS x, o[1:i - 1] AS before FROM orders, letters),
found AS (
  SELECT part, o, step, x, docs, good, toxic, f[x] AS fails, len(list_filter(before, lambda k: f[k])) > 0 AS gone,
    len(list_filter([1, 2, 3, 4, 5], lambda k: f[k])) AS n
  FROM masks, steps),
sums AS (
  SELECT part, o, step, x, sum(CASE WHEN NOT fails AND NOT gone THEN docs ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails AND NOT gone THEN docs ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND gone THEN docs ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails AND n = 1 THEN docs ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM found GROUP BY ALL)
SELECT part, list_aggregate(list_transform(o, lambda k: chr(64 + k)), 'string_agg', '') AS filter_order, step, kept, removed, redundant,
  unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM sums
"""
