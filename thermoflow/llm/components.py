"""Connected components of a graph given by its edges, as repeated aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from thermoflow.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)
    ).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node with an edge; a component is named by its least node.

    Alternates two steps: every node hands its larger neighbours, then its smaller ones, to the
    least of them, until nothing changes (a number of rounds that grows with the logarithm of the
    size). Edges only, ``a > b``; each round is a written table, so a lost executor costs one round. Minima are partial
    aggregates, and the joins that follow may be split where one node has very many edges.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = written(
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), name,
        )
        mark, before = _mark(edges), mark
        if mark == before:
            break
    # Every edge now leads to the least node of its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
