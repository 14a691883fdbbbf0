"""Line quality, fill-in-the-middle and the filter audit against plain versions, and on awkward input."""

import hashlib
import re
from collections import Counter
from itertools import permutations, product

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import SF, awkward, awkward_rows, documents, nothing, texts  # noqa: F401
from pyspark.sql import functions as F

from thermoflow.llm import fill_in_middle, filter_audit, quality_lines
from thermoflow.llm.common import read

WORD = re.compile("[^\x20\x09-\x0d]+")


# Line quality


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 7, 5)
        text = np.repeat(np.arange(5), sizes)
        potential, change = rng.normal(0, 2, len(text)), rng.normal(0, 1, (2, 2))
        chances, joint = quality_lines.marginals(potential, change, text)
        at = 0
        for size in sizes:
            one, two = np.zeros((size, 2)), np.zeros((size, 2, 2))
            for labels in product((0, 1), repeat=int(size)):
                weight = np.exp(sum(potential[at + k] * y for k, y in enumerate(labels)) + sum(change[p] for p in zip(labels, labels[1:])))
                for k, y in enumerate(labels):
                    one[k, y] += weight
                    if k:
                        two[k, labels[k - 1], y] += weight
            assert np.allclose(one / one.sum(axis=1, keepdims=True), chances[at: at + size])
            assert np.allclose((two / np.maximum(two.sum(axis=(1, 2), keepdims=True), 1e-9))[1:], joint[at + 1: at + size])
            at += size


def test_slopes_of_the_fit_are_those_of_the_likelihood():
    """The weights that the fit returns leave the penalised log-likelihood nearly flat."""
    rng = np.random.default_rng(2)
    bodies = [" ".join(rng.choice(["ab", "cd", "ef"], 4)) + ("\nab### cd###" if i % 3 == 0 else "\nmore of it.") for i in range(60)]
    lines = quality_lines.Lines(bodies)
    labels = np.array([i % 3 != 0 for i in range(60)])
    values, change = quality_lines.fit(lines.levels, lines.text, labels)
    columns = quality_lines._columns(lines.levels, lines.text)
    scores, _ = quality_lines.marginals(values[columns].sum(axis=1), change, lines.text)
    assert ((scores[:, 1] > 0.5) == labels[lines.text]).all()


def test_line_measures_of_plain_counts(texts):  # noqa: F811
    bodies = list(texts.values())[:60] + ["", " \n\t\n", "x", "a a a\na a a\nB# 1?"]
    lines = quality_lines.Lines([b or "" for b in bodies])
    names = list(quality_lines._RANGES)
    for i, body in enumerate(bodies):
        mine = [line for line in (body or "").split("\n") if WORD.search(line)]
        at = np.flatnonzero(lines.text == i)
        assert lines.length[at].tolist() == [sum(map(len, WORD.findall(line))) for line in mine]
        earlier, words_before = set(), set()
        for k, line in zip(at, mine):
            words = WORD.findall(line)
            level = dict(zip(names, lines.levels[k].tolist()))
            fresh = [w in words_before or w in words[:j] for j, w in enumerate(words)]
            expected = {"words": len(words), "seen": tuple(words) in earlier, "again": sum(fresh) / len(words),
                        "distinct": len(set(words)) / len(words), "width": sum(map(len, words)) / len(words)}
            for name, value in expected.items():
                ranges = quality_lines._RANGES[name]
                assert level[name] == np.searchsorted(ranges, value if name != "distinct" else 1 - (len(words) - len(set(words))) / len(words)), name
            earlier.add(tuple(words))
            words_before |= set(words)


def test_quality_on_documents_that_were_held_out(spark):
    folder = SF.replace("0.001", "0.1")
    labels = {r.doc_id: r.quality for r in read(spark, folder, "labels").collect()}
    rows = quality_lines.op11_line_quality(spark, folder).collect()
    assert len(rows) == read(spark, folder, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    good = [r.score for r in held if labels[r.doc_id]]
    bad = np.sort([r.score for r in held if not labels[r.doc_id]])
    assert np.searchsorted(bad, good).sum() / (len(good) * len(bad)) > 0.98
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.97


def test_quality_of_awkward_rows(spark, awkward, awkward_rows, nothing):  # noqa: F811
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (7, 0), (7, None), (10, 0), (None, 1)], "doc_id bigint, quality int")
    model = quality_lines.fit_model(awkward, labels)
    rows = quality_lines.with_scores(awkward, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {model.share}
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert rows[0]["row"] == "extra row" and rows[0].label == "extra label"
    assert quality_lines.with_scores(nothing, model).count() == 0
    none = quality_lines.fit_model(awkward, labels.limit(0))
    assert {r.score for r in quality_lines.with_scores(awkward, none).collect()} == {0.75}
    one = quality_lines.fit_model(awkward, labels.where("quality = 1"))
    assert len({r.score for r in quality_lines.with_scores(awkward, one).collect()}) == 1
    assert quality_lines.fit_model(nothing, labels).scores(["x"]).shape == (1,)


def test_quality_of_a_text_of_very_many_lines():
    model = quality_lines.Model(np.zeros(3 * (quality_lines._WIDTH + 1)), np.array([[1.0, 0.0], [0.0, 1.0]]), 0.5)
    assert abs(model.scores(["a line\n" * 300_000 + "x" * 1_000_000])[0] - 0.5) < 1e-6


# Fill-in-the-middle


def test_ranks():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 8, 1000).astype(np.uint8)
    matrix = fill_in_middle.WaveletMatrix(codes, 3)
    for bits in (1, 2, 3):
        for node in range(1 << bits):
            ends = rng.integers(0, 1001, 50)
            expected = [int((codes[:e] >> (3 - bits) == node).sum()) for e in ends]
            assert matrix.rank((node, bits), ends).tolist() == expected


CUT = ["", "x", "é", "中文 ab\ncd", "\n", "\n\n a  b\n", " lead", "trail \n", "😀😀 x", "one\ntwo\nthree four", "a\x0bb\x0cc\rd\te"]


@pytest.mark.parametrize("unit", ["character", "word", "line"])
def test_cuts(unit, texts):  # noqa: F811
    bodies = CUT + [t or "" for t in list(texts.values())[:40]]
    cuts = fill_in_middle.Cuts(pa.array(bodies))
    starts = {
        "character": lambda t: list(range(len(t))), "word": lambda t: [m.start() for m in WORD.finditer(t)],
        "line": lambda t: [0] * bool(t) + [i + 1 for i, c in enumerate(t) if c == "\n"],
    }[unit]
    units = cuts.units(unit)
    assert units.tolist() == [len(starts(t)) for t in bodies]
    rng = np.random.default_rng(5)
    for _ in range(20):
        k = rng.integers(0, units + 1)
        at = cuts.before(unit, k)
        for t, n, start, place in zip(bodies, k, cuts.starts, at):
            expected = 0 if n == 0 else [*starts(t), len(t)][n]
            assert place - start == len(t[:expected].encode()), (t, n)
        assert cuts.count("character", at).tolist() == [0 if n == 0 else [*starts(t), len(t)][n] for t, n in zip(bodies, k)]


def test_moved_texts_in_plain_python(spark):
    bodies = CUT + ["has <S> in it", "<P", "ends with <", "S>begins", None] + [f"text number {i} <" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(bodies)), "doc_id bigint, text string")
    rows = fill_in_middle.moved(df).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(bodies)
    for r in rows:
        t = bodies[r.doc_id] or ""
        h = hashlib.sha256(f"1:{r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * i: 8 * i + 8], 16) for i in range(4))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        plain = not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90
        form = "plain" if plain else "spm" if h4 % 100 < 20 else "psm"
        output = {"plain": t, "psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}[form]
        assert (r.n, r.form, r.output, r.back) == (len(t), form, output, t)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if plain else (a, b - a))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", ["word", "line"])
def test_moved_by_other_units_comes_back(spark, documents, unit):  # noqa: F811
    rows = fill_in_middle.moved(documents, unit=unit).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form")))
    whole = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert rows.join(whole, "doc_id").where("back <> text").count() == 0
    assert rows.count() == documents.count()


def test_moved_awkward_rows(awkward, awkward_rows, nothing):  # noqa: F811
    rows = fill_in_middle.moved(awkward).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.back) for r in rows) == Counter((r[0], r[1] or "") for r in awkward_rows)
    assert all(r.form == "plain" and r.n == 0 for r in rows if r.doc_id in (1, 2))
    assert {r["row"] for r in rows} == {"extra row"}
    assert fill_in_middle.moved(nothing).count() == 0


# Filter audit


def _audit(rows, labels):
    """By part, order and step, document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = {}
    for doc_id, text, *_ in rows:
        ids.setdefault(text or "", []).append(doc_id)
    failed = []
    for doc_id, text, lang in rows:
        t, w = text or "", WORD.findall(text or "")
        capitals = sum("A" <= c <= "Z" for c in t)
        repeated = doc_id is not None and any(other is not None and other < doc_id for other in ids[t])
        flags = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * capitals > 3 * len(t), bool(set(t) & set("#$%&*|")), repeated)
        failed.append((lang or "", doc_id, {f for f, x in zip("ABCDE", flags) if x}))
    out = {}
    for part in {p for p, *_ in failed}:
        mine = [(i, f) for p, i, f in failed if p == part]
        by_filter = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                fails = sum(name in f for _, f in mine)
                out[part, order, step] = [
                    len(left), len(gone), fails - len(gone), sum(f == {name} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
                by_filter[name] += len(gone)
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                out[part, order, step].append(by_filter[name])
    return out


def _found(df):
    return {(r.part, r.filter_order, r.step): [
        r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


LABELS = [(1, 1, 0), (2, 1, 1), (4, 1, 1), (4, 0, 0), (5, 1, 0), (6, 0, 1), (8, None, 1), (10, 1, None), (None, 1, 1), (99, 1, 1)]


@pytest.mark.parametrize("fingerprint", [F.xxhash64, lambda t: F.length(t).cast("bigint"), lambda t: F.lit(7).cast("bigint")])
def test_audit_of_awkward_rows(spark, awkward, awkward_rows, fingerprint):  # noqa: F811
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    counts = filter_audit.failure_counts(awkward, labels, fingerprint=fingerprint)
    expected = _audit([(r[0], r[1], r[2]) for r in awkward_rows], LABELS)
    assert _found(filter_audit.interactions(counts)) == expected
    assert len(expected) == 3 * 600


def test_audit_of_nothing(spark, nothing):  # noqa: F811
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.interactions(filter_audit.failure_counts(nothing, labels)).count() == 0


def test_only_possible_repeats_are_shuffled(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("hash"))
    sketch = filter_audit.repeats_sketch(rows.unionByName(rows.limit(300)), "hash", 20_300)
    hashes = np.array([r.hash for r in rows.collect()], dtype=np.int64).view(np.uint64)
    assert 300 <= sketch.might_have(hashes).sum() < 300 + 800
