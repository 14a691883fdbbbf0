"""Nulls, empty and long texts, ties, repeated rows, clashing names and empty tables, for every operator and stage."""

from collections import Counter

import corpus_pipeline
import pytest
from llm_cases import SF, awkward, awkward_rows, documents, nothing  # noqa: F401
from oracle_check import connect, differences
from pyspark.sql import functions as F

from thermoflow.llm import (
    decontamination, line_dedup, ngram_jaccard_join, pfair_mixing, quality_rules, quotation_links, secret_scans,
    substring_dedup, token_counts, toxicity,
)
from thermoflow.llm.common import read
from thermoflow.llm.components import components
from thermoflow.llm.registered import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_quality_rules(awkward, awkward_rows, nothing):  # noqa: F811
    rows = quality_rules.apply_rules(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9].n_words == 60_001 and by_id[9].n_repeat_words == 60_000 and by_id[9].base_failed
    assert by_id[10].n_dup_lines == 499
    assert quality_rules.apply_rules(nothing).count() == 0


def test_hosts_are_shrunk(spark):
    rows = [(f"good{i}", i % 10 == 0) for i in range(5) for _ in range(200)] + [("tiny", True)] * 2 + [("bad", True)] * 400
    judged = spark.createDataFrame(rows, "host string, failed boolean")
    verdicts = {r.host: r for r in quality_rules.host_verdicts(judged, "host", "failed").collect()}
    assert verdicts["bad"].host_rejected and verdicts["bad"].host_rate < 1
    assert verdicts["tiny"].host_rate < verdicts["bad"].host_rate
    url = spark.range(1).select(quality_rules.host_of_url(F.lit("https://WWW.Example.org/a?b")).alias("h")).first()
    assert url.h == "www.example.org"


def test_near_duplicates(awkward, nothing):  # noqa: F811
    rows = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_jaccard_join.near_duplicates(awkward).collect())
    assert rows == Counter({
        (None, None, 0): 2, (1, 1, 0): 1, (2, 2, 0): 1, (3, 3, 0): 1, (4, 4, 2): 2, (5, 4, 2): 1, (6, 6, 1): 1, (7, 6, 1): 1, (8, 8, 0): 1,
        (9, 9, 0): 1, (10, 10, 0): 1, (11, 11, 0): 2,
    })
    assert ngram_jaccard_join.near_duplicates(nothing).count() == 0


def test_secret_scans(awkward, awkward_rows, nothing):  # noqa: F811
    rows = secret_scans.scan(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    assert sorted(r.spans for r in rows if r.doc_id == 11) == ["", "assign:0:49,hex:9:49,guess:9:49"]
    assert secret_scans.scan(nothing).count() == 0


def test_decontamination(awkward, nothing):  # noqa: F811
    items = awkward.select(F.col("doc_id").alias("item_id"), "text", "row")
    rows = {(r.doc_id, r.item_id): r.n_windows for r in decontamination.report(awkward, items).collect()}
    assert {i for d, i in rows if d == 5} == {4, 5} and {i for d, i in rows if d is None} == {4, 5}
    assert rows[(5, 4)] == 59 and not any(d in (1, 2, 3, 6, 7) for d, _ in rows)
    assert decontamination.report(nothing, items).count() == 0
    assert decontamination.report(awkward, nothing.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_token_counts(awkward, awkward_rows, nothing):  # noqa: F811
    rows = token_counts.prefix_tables(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    assert all((r.n_bytes, r.n_tokens, r.fitting_chars) == (0, 0, 0) for r in rows if r.doc_id in (1, 2))
    assert token_counts.prefix_tables(nothing).count() == 0


def test_quotation_links(spark):
    rows = [
        (1, 1, "user", "First point here. Second point\nover two lines.\n\nThird."),
        (1, 2, "bot", "> Second point over\n> two lines.\nI agree."),
        (1, 3, "user", "> > Second point\n> > over two lines.\n> I agree.\nGood."),
        (1, 4, "user", "> Third.\n> not there\nLate answer."), (1, 5, "bot", "No quote. I agree."), (1, 6, "bot", ">I agree.\n"),
        (1, 6, "bot", ">I agree.\n"), (2, 1, "user", "> Second point over two lines."), (2, None, None, "> x"), (None, 1, "u", "> First point here."),
        (3, 1, None, None), (3, 2, "u", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {n: F.lit("extra") for n in ("body", "said", "root", "depth", "hash", "range", "text_key")}
    )
    got = quotation_links.link_quotes(df)
    by_turn = Counter((r.conv_id, r.turn, r.reply_to, r.root, r.depth) for r in got.collect())
    assert by_turn == Counter({
        (1, 1, None, 1, 0): 1, (1, 2, 1, 1, 1): 1, (1, 3, 2, 1, 2): 1, (1, 4, 1, 1, 1): 1, (1, 5, None, 5, 0): 1, (1, 6, 5, 5, 1): 2,
        (2, 1, None, 1, 0): 1, (2, None, None, None, 0): 1, (None, 1, None, 1, 0): 1, (3, 1, None, 1, 0): 1, (3, 2, None, 2, 0): 1,
    })
    assert {r.turn: r.body for r in got.where("conv_id = 1").collect()}[3] == "Good."
    ordered = [(r.root, r.turn) for r in quotation_links.in_reply_order(got.where("conv_id = 1"), 3).collect()]
    assert ordered == sorted(ordered)
    assert quotation_links.link_quotes(df.limit(0)).count() == 0


def test_quotes_over_many_ranges_of_turns(spark):
    df = spark.range(1, 3001).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"),
        F.when(F.col("id") == 1, "Only here.").when(F.col("id") % 1000 == 0, F.lit("> Only here.\nYes.")).otherwise(
            F.concat(F.lit("Turn "), F.col("id"))).alias("text"),
    )
    rows = quotation_links.link_quotes(df).where("reply_to IS NOT NULL").collect()
    assert sorted((r.turn, r.reply_to) for r in rows) == [(1000, 1), (2000, 1), (3000, 1)]


def test_line_dedup(awkward, awkward_rows, nothing):  # noqa: F811
    rows = line_dedup.remove_lines(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    removed = Counter((r.doc_id, r.n_removed) for r in rows)
    assert removed[(4, 1)] == 2 and removed[(5, 1)] == 1 and removed[(6, 0)] == 1 and removed[(7, 1)] == 1 and removed[(10, 499)] == 1
    assert removed[(None, 0)] == 2
    assert {r.row for r in rows} == {"extra row"} and rows[0]["_key"] == "extra _key"
    assert line_dedup.remove_lines(nothing).count() == 0


def test_substring_dedup(awkward, awkward_rows, nothing):  # noqa: F811
    rows = substring_dedup.remove_repeats(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    assert {(r.doc_id, r.n_removed) for r in rows if r.n_removed} == {(5, 70)}
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_toxicity(spark, awkward, awkward_rows, nothing):  # noqa: F811
    none = spark.createDataFrame([], "doc_id bigint, toxic int, text string")
    model = toxicity.fit_model(awkward, none)
    scores = toxicity.with_scores(awkward, model).collect()
    assert Counter(r.doc_id for r in scores) == Counter(r[0] for r in awkward_rows)
    assert {round(r.score, 6) for r in scores} == {0.25}
    labels = spark.createDataFrame(
        [(4, 1, "x"), (4, 0, "x"), (6, 1, "x"), (7, 0, "x"), (8, 0, None), (None, 1, "x"), (9, None, "x"), (10, 0, "x")], none.schema
    )
    model = toxicity.fit_model(awkward, labels)
    kept = toxicity.without_toxic(awkward, model)
    assert kept.columns == awkward.columns
    assert toxicity.with_scores(nothing, model).count() == 0 == toxicity.without_toxic(nothing, model).count()
    assert toxicity.fit_model(nothing, labels)[2] < 0


def test_mixing(awkward, awkward_rows, nothing):  # noqa: F811
    rows = pfair_mixing.mix(awkward, block=2).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    assert len({r.position for r in rows}) == len(rows)
    assert pfair_mixing.mix(nothing).count() == 0
    with pytest.raises(ValueError):
        pfair_mixing.mix(awkward, targets={"a": 1.0})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, awkward, nothing, name, stage):  # noqa: F811
    rows = stage(spark, awkward, SF)
    ids = Counter(r.doc_id for r in rows.collect())
    assert ids[8] == 1 and ids[None] == 2 and ids[9] == 1
    if name != "mixing":
        assert rows.columns == awkward.columns
    if name == "ngram_jaccard_join":
        assert ids[4] == 1 and ids[5] == 0 and ids[7] == 0 and ids[11] == 2
    assert stage(spark, nothing, SF).count() == 0


def test_pipeline_as_a_whole(spark, documents):  # noqa: F811
    rows = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 0.6 * documents.count()
    assert rows.columns == [*documents.columns, "block", "slot", "place", "position"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stages_against_plain_versions(spark, documents):  # noqa: F811
    """Each stage on what its predecessor kept: which documents go, by plain versions of the operators."""
    from brute import near_duplicates, overlaps

    from thermoflow.llm.common import written

    docs, ids, texts = documents, {}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "stage")
        rows = docs.collect()
        ids[name], texts[name] = {r.doc_id for r in rows}, {r.doc_id: r.text for r in rows}
        assert len(rows) == len(ids[name]) and docs.columns == documents.columns
        assert all(r.n_chars == len(r.text) for r in rows)
    given = {r.doc_id: r.text for r in documents.collect()}
    toxic = {r.doc_id for r in toxicity.op9_toxicity(spark, SF).collect() if r.predicted}
    assert ids["toxicity"] == set(given) - toxic
    for d, text in texts["line_dedup"].items():
        left = Counter(text.split("\n"))
        assert not left - Counter(given[d].split("\n"))
    classes = near_duplicates(texts["line_dedup"])
    assert ids["ngram_jaccard_join"] == {d for d, (class_id, _) in classes.items() if class_id == d}
    items = {r.item_id: r.text for r in read(spark, SF, "benchmark").collect()}
    assert ids["decontamination"] == ids["ngram_jaccard_join"] - {d for d, _ in overlaps(texts["ngram_jaccard_join"], items)}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in mixed} == ids["decontamination"] and sorted(r.position for r in mixed) == sorted({r.position for r in mixed})
