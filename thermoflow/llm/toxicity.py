"""Toxic texts: a linear classifier over character n-grams, scaled by naive Bayes ratios.

Features are the n-grams (3 to 6 characters) that occur in a text, in lower case, with
everything but letters and digits as one blank. Each is scaled by its log-count ratio between
toxic and other training texts, and a logistic regression over the scaled features is
averaged with the plain ratios. Scores are probabilities.

The fit takes a bounded sample of the labelled rows: about ``SAMPLE`` of them, chosen by a hash of
the id, of those whose ``crc32(doc_id) mod 5`` is not 0. It runs in one task, and its
result has at most ``FEATURES`` weights. Scoring reads every whole text where it lies.

Null or empty text: scored by the intercept alone. Null id: held out. Ids labelled
twice: the higher label counts; ids with several texts: the first in order trains.
Without any label, or with one class only, the score is the smoothed share of toxic labels (0.25
without labels). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermoflow.llm.batches import BASE, mixed, slices
from thermoflow.llm.common import map_arrow, read, ship, text_of

#: Labelled rows that train, about.
SAMPLE = 10_000
#: Weights kept, at most.
FEATURES = 30_000
SIZES = (3, 4, 5, 6)
BITS = 20
THRESHOLD = 0.5
_MIX = 0.75
_ROUNDS = 200
_PENALTY = 1e-4

_U = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def normal_text(text: str = "text") -> Column:
    """Lower case, blank for anything but letters and digits, one at either end."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text_of(text)), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size of n-grams: the text's index and the feature, for every place."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(len(points))
    h = np.zeros(len(points), dtype=np.uint64)
    for size in range(1, max(SIZES) + 1):
        count = len(points) - size + 1
        if count <= 0:
            return
        h = h[:count] * BASE + points[size - 1:] + _U(1)
        if size in SIZES:
            whole = place[:count] + size <= ends[:count]
            feature = (mixed(h) >> _U(64 - BITS)).astype(np.int64)
            yield owner[:count][whole], feature[whole]


def _distinct(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), each once. ``wanted`` marks the features to look for."""
    keys = []
    for owner, feature in _grams(texts):
        if wanted is not None:
            hit = wanted[feature]
            owner, feature = owner[hit], feature[hit]
        keys.append(owner * (1 << BITS) + feature)
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.int64)
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _pieces(texts: list[str], limit: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters, with the index of the first."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield first, texts[first: i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, their weights and the intercept."""
    labels = np.asarray(labels, dtype=np.float64)
    positive, total = float(labels.sum()), len(labels)
    prior = np.log((positive + 0.5) / (total - positive + 1.5))
    if positive in (0.0, float(total)):
        return np.zeros(0, dtype=np.int64), np.zeros(0), float(prior)
    counts = np.zeros((2, 1 << BITS))
    for first, piece in _pieces(texts):
        owner, feature = _distinct(piece)
        toxic = labels[first + owner] > 0
        counts[1] += np.bincount(feature[toxic], minlength=1 << BITS)
        counts[0] += np.bincount(feature[~toxic], minlength=1 << BITS)
    ratio = np.log((counts[1] + 0.5) / (positive + 1)) - np.log((counts[0] + 0.5) / (total - positive + 1))
    # How many standard errors the ratio is away from 0; what is seen once says little.
    strength = np.abs(ratio) / np.sqrt(1 / (counts[1] + 0.5) + 1 / (counts[0] + 0.5))
    strength[counts.sum(0) < 3] = 0
    strength[strength < 2.5] = 0
    chosen = np.argsort(-strength, kind="stable")[:FEATURES]
    chosen = np.sort(chosen[strength[chosen] > 0])
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[chosen] = True
    at = np.zeros(1 << BITS, dtype=np.int64)
    at[chosen] = np.arange(len(chosen))
    rows, columns = [], []
    for first, piece in _pieces(texts):
        owner, feature = _distinct(piece, wanted)
        rows.append(first + owner)
        columns.append(at[feature])
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    scale = ratio[chosen]
    values = scale[columns]
    weights, bias = np.zeros(len(chosen)), float(prior)
    # Adam on the whole sample.
    m, v, step = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1), 0.02
    for i in range(1, _ROUNDS + 1):
        margin = bias + np.bincount(rows, values * weights[columns], minlength=total)
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels) / total
        gradient = np.append(np.bincount(columns, values * error[rows], minlength=len(chosen)) + _PENALTY * weights, error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        move = step * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    mixed_weights = _MIX * weights + (1 - _MIX) * np.abs(weights).mean()
    return chosen, mixed_weights * scale, float(bias)


def fit_model(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              label: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on a sample of the labelled rows that are not held out."""
    spark = documents.sparkSession
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("label"))
    )
    rows = known.count()
    # The hash keeps about ``sample`` rows, the same ones at every run; so the join's side is bounded.
    share = min(1.0, sample / max(rows, 1))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    trained = (
        documents.select(F.col(doc_id).alias("doc_id"), normal_text(text).alias("text"))
        .join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    )
    ship(spark)

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            marks += batch.column("label").to_pylist()
        order = sorted(range(len(texts)), key=lambda i: texts[i])
        features, weights, bias = fit([texts[i] for i in order], np.array([marks[i] for i in order]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(features, -1)), pa.array(np.append(weights, bias))], names=["feature", "weight"]
        )

    model = trained.coalesce(1).mapInArrow(fit_rows, "feature bigint, weight double").toPandas()
    model = model[~model.feature.duplicated()]
    weighted = model[model.feature >= 0]
    bias = model.weight[model.feature < 0]
    return (weighted.feature.to_numpy(np.int64), weighted.weight.to_numpy(),
            float(bias.iloc[0]) if len(bias) else float(np.log(0.5 / 1.5)))


def _scorer(model):
    """A function from normalised texts to scores."""
    features, weights, bias = model
    table = np.zeros(1 << BITS)
    table[features] = weights
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[features] = True

    def scores(texts: list[str]) -> np.ndarray:
        owner, feature = _distinct(texts, wanted)
        margin = bias + np.bincount(owner, table[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))

    return scores


def with_scores(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text",
                score: str = "score") -> DataFrame:
    """The input without its text and with a score for each row (in place of a column of that name)."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (text, score)]
    body = df.select(*kept, normal_text(text).alias(text))
    schema = body.select(*kept).schema.add(score, "double")

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(sent.value)
        for batch in slices(batches, text, 1 << 18):
            rest = batch.drop_columns([text])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(scores(batch.column(text).to_pylist()))], names=[*rest.schema.names, score]
            )

    return map_arrow(body, score_batches, schema)


def without_toxic(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    # Only the normalised text goes to Python; the rows wait in Spark.
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores = _scorer(sent.value)
        for batch in batches:
            texts = batch.tolist()
            kept = [scores(piece) < threshold for _, piece in _pieces(texts)]
            yield pd.Series(np.concatenate(kept) if kept else np.zeros(0, dtype=bool))

    return df.where(clean(normal_text(text)))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    model = fit_model(documents, read(spark, folder, "labels"))
    return with_scores(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
