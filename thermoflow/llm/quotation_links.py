"""Conversations without quotes, in reply order: quoted passages linked to their originals.

A line that starts with one or more ``>`` is quoted, as deep as there are ``>``. Neighbouring lines of one
depth are a passage. Passages, and a message's own lines, are cut into sentences (so that a
passage still matches when its lines are wrapped anew or only a part of it is quoted), the sentences are normalised and hashed, and each quoted
sentence is joined to the latest earlier message of its conversation that says it itself.
A message replies to the message that most sentences of its shallowest linked depth point to (ties: the latest).
Following replies leads to the root of each thread.

Reply order: by conversation, root, turn. A reply always has a larger turn than what it replies to, so in this
order every message follows what it answers, thread by thread.

At scale: messages are parsed where they lie. The latest earlier message comes from two steps of windows over
ranges of ``TURNS`` turns with a carried value, over distinct (sentence, turn) only, so a conversation with
very many messages, or a sentence that it repeats in each, is never gathered in one task. No pairs of messages are formed.
Roots take a number of joins that grows with the logarithm of the longest reply chain.

Null text: as empty. Rows with a null conversation or turn: kept, never linked, their root is their own turn. Rows with equal
conversation and turn: each is linked on its own; replies point to the turn; where such rows reply to several
turns, the thread follows the latest. Whole texts are parsed. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from thermoflow.llm.batches import slices
from thermoflow.llm.common import map_arrow, read, text_of, written

#: Turns of one range.
TURNS = 1024

_QUOTE = re.compile(r"[ \t]*(?:>[ \t]?)+")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
_PLAIN = re.compile(r"[\W_]+")


def parse(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """The text without quoted lines, and its runs of lines of one depth (0: its own)."""
    own, runs, depth = [], [], None
    for line in text.split("\n"):
        quote = _QUOTE.match(line)
        at = quote[0].count(">") if quote else 0
        content = line[quote.end():] if quote else line
        if not at:
            own.append(line)
        if at != depth:
            runs.append((at, []))
            depth = at
        runs[-1][1].append(content)
    return "\n".join(own), runs


def sentences(lines: list[str]) -> list[str]:
    """The normalised sentences of some lines, without empty ones."""
    plain = (_PLAIN.sub(" ", s.lower()).strip() for s in _SENTENCE_END.split(" ".join(lines)))
    return [s for s in plain if s]


def _digest(sentence: str) -> int:
    return int.from_bytes(blake2b(sentence.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _parsed(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text_key, body, n_passages, said``: the hash of each sentence with its depth."""
    kept = ["conv_id", "turn", "role", "text_key"]

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bodies, passages, said = [], [], []
            for text in batch.column("text").to_pylist():
                body, runs = parse(text)
                bodies.append(body)
                passages.append(sum(depth > 0 for depth, _ in runs))
                said.append([{"depth": d, "hash": _digest(s)} for d, lines in runs for s in sentences(lines)])
            kind = pa.list_(pa.struct([("depth", pa.int32()), ("hash", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(bodies, pa.string()), pa.array(passages, pa.int64()),
                 pa.array(said, kind)],
                names=[*kept, "body", "n_passages", "said"],
            )

    return written(map_arrow(
        messages, parse_batches,
        "conv_id bigint, turn bigint, role string, text_key bigint, body string, n_passages bigint, "
        "said array<struct<depth:int,hash:bigint>>",
    ), "messages")


def _originals(said: DataFrame) -> DataFrame:
    """``conv_id, hash, turn, original``: for each quoted sentence, the latest earlier turn that says it itself."""
    places = said.groupBy("conv_id", "hash", "turn").agg(
        F.max(F.col("depth") == 0).alias("own"), F.max(F.col("depth") > 0).alias("quoted")
    ).withColumn("range", F.floor(F.col("turn") / TURNS))
    own = F.when(F.col("own"), F.col("turn"))
    carried = (
        places.groupBy("conv_id", "hash", "range").agg(F.max(own).alias("last"))
        .withColumn("carried", F.max("last").over(
            Window.partitionBy("conv_id", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        )).drop("last")
    )
    inside = F.max(own).over(
        Window.partitionBy("conv_id", "hash", "range").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        places.withColumn("inside", inside).where("quoted")
        .join(carried, ["conv_id", "hash", "range"])
        .select("conv_id", "hash", "turn", F.coalesce("inside", "carried").alias("original")).where("original IS NOT NULL")
    )


def _roots(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, root, depth`` of the messages that reply to others. ``replies``: conv_id, turn, reply_to."""
    open_rows = written(replies.select(
        "conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("bigint").alias("depth")
    ), "replies")
    known, done = open_rows, []
    while True:
        # Every open row takes over the root that its own root has reached so far.
        longer = written(open_rows.alias("a").join(
            known.alias("b"), (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("a.root") == F.col("b.turn")), "left"
        ).select(
            "a.conv_id", "a.turn", F.coalesce("b.root", "a.root").alias("root"),
            (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth"), F.col("b.turn").isNotNull().alias("moved"),
        ), "replies")
        # Rows whose root replies to nothing are done; only the others go another round.
        done.append(longer.where("NOT moved").drop("moved"))
        open_rows = longer.where("moved").drop("moved")
        known = reduce(DataFrame.unionByName, done, open_rows)
        if open_rows.isEmpty():
            return known


def link_quotes(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per message: ``conv_id, turn, role, body`` (without quotes), ``n_passages, n_linked`` (quoted sentences
    with an original), ``reply_to, root, depth``."""
    messages = df.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"), text_of(text).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    parsed = _parsed(messages)
    said = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", "text_key", F.explode("said").alias("s")
    ).select("conv_id", "turn", "text_key", "s.depth", "s.hash").distinct()
    votes = (
        said.where("depth > 0").join(_originals(said), ["conv_id", "hash", "turn"])
        .groupBy("conv_id", "turn", "text_key", "depth", "original").agg(F.count(F.lit(1)).alias("n"))
    )
    links = written(votes.groupBy("conv_id", "turn", "text_key").agg(
        F.max(F.struct(-F.col("depth"), F.col("n"), F.col("original"))).alias("best"), F.sum("n").alias("n_linked")
    ).select("conv_id", "turn", "text_key", F.col("best.original").alias("reply_to"), "n_linked"), "reply-links")
    roots = _roots(links.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("reply_to")))
    return (
        parsed.drop("said").join(links, ["conv_id", "turn", "text_key"], "left").join(roots, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "body", "n_passages", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "reply_to",
            F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"),
        )
    )


def in_reply_order(linked: DataFrame, partitions: int) -> DataFrame:
    """The messages sorted over all partitions, thread by thread."""
    order = ["conv_id", "root", "turn"]
    return linked.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def with_quotes(messages: DataFrame) -> DataFrame:
    """Each message as a mail program would send it: above its text, quotes of the one before, and of the one before that."""
    said = messages.groupBy("conv_id", "turn").agg(F.min("text").alias("quoted"))
    out = messages
    for back in (1, 2):
        out = out.join(
            said.select("conv_id", (F.col("turn") + back).alias("turn"),
                        F.concat(F.regexp_replace("quoted", "(?m)^", "> " * back), F.lit("\n")).alias(f"_quote{back}")),
            ["conv_id", "turn"], "left",
        )
    return out.withColumn("text", F.concat(
        F.coalesce("_quote2", F.lit("")), F.coalesce("_quote1", F.lit("")), F.coalesce("text", F.lit(""))
    )).drop("_quote1", "_quote2")


def op6_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations, each turn quoting the two before it, taken apart again."""
    threads = with_quotes(read(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    return link_quotes(threads).select(
        "conv_id", "turn", "role", F.sha2("body", 256).alias("body_sha256"), "n_passages", "reply_to", "root", "depth"
    )


SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
    regexp_matches(coalesce(text, ''), '[^\s_!-/:-@\[-`{-~]') AS speaks
  FROM conversations),
turns AS (SELECT conv_id, turn, bool_or(speaks) AS speaks FROM m GROUP BY ALL),
linked AS (
  SELECT m.*, p.turn IS NOT NULL AS quotes, q.turn IS NOT NULL AS quotes_deep,
    CASE WHEN p.speaks THEN m.turn - 1 WHEN q.speaks THEN m.turn - 2 END AS reply_to
  FROM m LEFT JOIN turns p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1
         LEFT JOIN turns q ON q.conv_id = m.conv_id AND q.turn = m.turn - 2),
-- Where no message is without words, a thread is a run of consecutive turns.
runs AS (
  SELECT conv_id, turn, max(CASE WHEN reply_to IS NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS root
  FROM (SELECT conv_id, turn, max(reply_to) AS reply_to FROM linked GROUP BY ALL))
SELECT conv_id, turn, role, sha256(text) AS body_sha256, quotes::BIGINT + quotes_deep::BIGINT AS n_passages, reply_to, root,
  turn - root AS depth
FROM linked JOIN runs USING (conv_id, turn)
"""
