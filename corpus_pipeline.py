"""The corpus pipeline: stages over the table of documents, each written and read again.

Every stage but the last returns the columns of its input. Rows without an id are judged like any
other; rows that repeat both id and text count as one document where one of a group stays. Null texts are kept by all
stages (they have no words). Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermoflow.llm import decontamination, line_dedup, ngram_jaccard_join, pfair_mixing, toxicity
from thermoflow.llm.common import packed, read, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. The classifier learns from the labelled ones that are not held out."""
    model = toxicity.fit_model(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing but blanks is left by that."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # The other columns travel as one, so no name of theirs can clash, and the text but once.
    deduped = line_dedup.remove_lines(docs.select(
        "doc_id", "text", packed(others).alias("row"), F.col("text").isNull().alias("no_text")
    )).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^ \t-\r]"))
    values = {"doc_id": F.col("doc_id"), "text": F.when(~F.col("no_text"), F.col("text"))}
    values |= {c: F.col("row")[c] for c in others}
    if "n_chars" in others:
        values["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(values["n_chars"])
    return deduped.select(*[values[c].alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays. Rows without an id stay.

    Documents are told apart by id and text, so rows that repeat an id with other texts are judged by their own text.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.where("doc_id IS NOT NULL").withColumn("row", F.struct(*docs.columns)).select(
        "row", F.xxhash64("doc_id", "text").alias("key"), F.to_json(packed(others)).alias("rest")
    )
    classes = ngram_jaccard_join.near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"))
    ids = rows.select(F.col("key").alias("doc_id"), F.col("row.doc_id").alias("id"))
    stays = (
        classes.join(ids, "doc_id").groupBy("class_id").agg(F.min(F.struct("id", "doc_id")).alias("least"))
        .select(F.col("least.doc_id").alias("key"))
    )
    # Of rows that repeat id and text one stays, the same one at every run.
    kept = rows.join(stays, "key", "left_semi").groupBy("key").agg(F.min_by("row", "rest").alias("row"))
    return kept.select("row.*").unionByName(docs.where("doc_id IS NULL"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with the benchmark go."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("key"), "text")
    leaks = decontamination.contaminated(rows.select(F.col("key").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    return rows.join(leaks.withColumnRenamed("doc_id", "key"), "key", "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their place in a mixture of the sources."""
    return pfair_mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: A trained classifier and hashed signatures can't be expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
