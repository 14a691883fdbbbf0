"""Quality of documents: a conditional random field over their lines.

Lines with anything but blanks are the nodes of a chain, each good or bad. Features of a line are measures of its
shape (what share of its characters are letters, capitals, symbols, how its words end, whether it or its words were there before), cut into
ranges; the features of the lines before and behind it count too, with weights of their own. Neighbouring labels have a weight for each
pair. The marginals of the labels come from forward and backward sums; a document's score is the mean
chance of its lines to be good, weighted by their length.

Forward and backward sums are products of 2 by 2 matrices, formed for all lines of a batch at once by doubling
(a first line's matrix forgets what is before it), so one text of a million lines takes no longer than as many short ones.

The fit takes labelled documents whose ``crc32(doc_id) mod 4`` is not 2: about ``SAMPLE`` of them, chosen by a hash of the id, of
those with at most ``MOST_LINES`` lines. Their lines have the label of the document. Features are made where the
texts lie; the fit is one task, over at most SAMPLE x MOST_LINES rows of ``MEASURES`` bytes, and gives a few hundred numbers.
Scoring reads every whole text where it lies.

Null text, or one without lines: the share of good documents in training. Null id: held out. Ids labelled twice: the
higher label counts; ids with several texts: the first in order trains. Without any label, or with one class only, every score is the smoothed share of
good labels (0.75 without labels). Repeated rows get the same score. Other columns are kept, ones named like the score are replaced. Empty
tables give empty tables.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from thermoflow.llm.batches import BASE, mixed, powers, slices
from thermoflow.llm.common import map_arrow, packed, read, text_of, written

#: Labelled documents that train, about, and the most lines one of them may have.
SAMPLE, MOST_LINES = 3_000, 500
THRESHOLD = 0.7
_ROUNDS, _RATE, _PENALTY = 100, 0.1, 2e-3
#: Ranges of each measure: shares of characters, shares of words, numbers of words and characters.
_SHARES = (0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
_RANGES = {
    "letters": _SHARES, "capitals": _SHARES, "digits": _SHARES, "symbols": _SHARES, "points": _SHARES,
    "ends": _SHARES, "bare": _SHARES, "again": _SHARES, "distinct": _SHARES,
    "words": (1, 2, 4, 8, 16, 32, 64, 128), "width": (1, 2, 3, 4, 5, 6, 8, 12, 20),
    "seen": (0,), "end": (0, 1),
}
MEASURES = len(_RANGES)
_SIZES = [len(r) + 1 for r in _RANGES.values()]
_FIRST = np.concatenate([[0], np.cumsum(_SIZES)])
#: One value more for each measure of a neighbour that isn't there.
_WIDTH = int(_FIRST[-1])
_NEIGHBOURS = (0, -1, 1)

_OTHER, _LETTER, _CAPITAL, _DIGIT, _SYMBOL, _POINT, _BLANK, _FEED = range(8)
_KINDS = {"Lu": _CAPITAL, "Lt": _CAPITAL, "Nd": _DIGIT}
_U = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _kind(point: int) -> int:
    if point == 0x0A:
        return _FEED
    if point == 0x20 or 0x09 <= point <= 0x0D:
        return _BLANK
    if chr(point) in ".,;:'\"?-()":
        return _POINT
    category = unicodedata.category(chr(point))
    return _KINDS.get(category) or (_LETTER if category[0] in "LM" else _SYMBOL if category[0] in "SP" else _OTHER)


_ASCII = np.array([_kind(p) for p in range(128)], dtype=np.int8)


def _kinds(points: np.ndarray) -> np.ndarray:
    kinds = _ASCII[np.minimum(points, 127)]
    far = points > 127
    if far.any():
        values, at = np.unique(points[far], return_inverse=True)
        kinds[far] = np.array([_kind(int(p)) for p in values], dtype=np.int8)[at]
    return kinds


def _seen_before(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether an equal hash of the same owner stands earlier."""
    keys = mixed(hashes + mixed(owner.astype(np.uint64) + _U(1)))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def _run_hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of runs that fill ``values``."""
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    return mixed(np.add.reduceat(values * powers(int(lengths.max()))[place], starts) + lengths.astype(np.uint64))


class Lines:
    """The lines of some texts that hold more than blanks: ``text`` (index), ``length`` and ``levels`` (a range for each measure)."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        kinds = _kinds(points)
        inside = kinds < _BLANK
        self.text = self.length = np.zeros(0, dtype=np.int64)
        self.levels = np.zeros((0, MEASURES), dtype=np.uint8)
        if not inside.any():
            return
        # Line feeds join the texts, so a line number tells the text.
        sizes = np.array([len(t) for t in texts])
        borders = np.cumsum(sizes + 1) - 1
        line_of = np.cumsum(kinds == _FEED) - (kinds == _FEED)
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        starts = np.flatnonzero(opens)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        ends = np.flatnonzero(closes) + 1
        lengths, numbers = ends - starts, line_of[starts]
        self._numbers, line = np.unique(numbers, return_inverse=True)
        count = len(self._numbers)
        first_word = np.searchsorted(numbers, self._numbers)
        self.text = np.searchsorted(borders, starts[first_word])
        # Counted without the blanks between words.
        at = np.searchsorted(self._numbers, line_of[inside])
        of = kinds[inside]
        chars = np.bincount(at, minlength=count)
        share = lambda k: np.bincount(at[of == k], minlength=count) / chars
        words = np.bincount(line, minlength=count)
        values = mixed(points[inside].astype(np.uint64) + _U(1))
        hashes = _run_hashes(values, np.cumsum(lengths) - lengths, lengths)
        by_line = _seen_before(line, hashes)
        by_text = _seen_before(self.text[line], hashes)
        part = lambda mask: np.bincount(line[mask], minlength=count) / words
        whole = mixed(np.add.reduceat(hashes * powers(int(words.max()), BASE)[np.arange(len(line)) - np.repeat(first_word, words)], first_word))
        last = first_word + words - 1
        has_letter = np.add.reduceat(np.isin(of, (_LETTER, _CAPITAL)), np.cumsum(lengths) - lengths) > 0
        final = kinds[ends - 1]
        measures = [
            share(_LETTER), share(_CAPITAL), share(_DIGIT), share(_SYMBOL), share(_POINT),
            part(final == _SYMBOL), part(~has_letter), part(by_text), 1 - part(by_line),
            words, chars / words, _seen_before(self.text, whole).astype(float), np.where(final[last] == _POINT, 2, final[last] == _SYMBOL),
        ]
        self.length = chars
        self.levels = np.stack([
            np.searchsorted(ranges, m, side="left").astype(np.uint8) for ranges, m in zip(_RANGES.values(), measures)
        ], axis=1)


def _columns(levels: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The features of each line and of its neighbours, as places in the weights; one spare place for none."""
    own = levels + _FIRST[:-1]
    out = [own]
    for step in _NEIGHBOURS[1:]:
        moved = np.roll(own, -step, axis=0)
        same = np.roll(text, -step) == text
        if len(text):
            same[-1 if step > 0 else 0] = False
        out.append(np.where(same[:, None], moved + (len(out) * (_WIDTH + 1)), len(out) * (_WIDTH + 1) + _WIDTH))
    return np.concatenate(out, axis=1)


def _scan(matrices: list[np.ndarray], longest: int) -> list[np.ndarray]:
    """Products of each matrix (four arrays of entries) with those before it, up to a factor.

    No product needs to reach further back than the ``longest`` chain.
    """
    a, b, c, d = matrices
    step = 1
    while step < min(longest, len(a)):
        w, x, y, z = (m[:-step] for m in (a, b, c, d))
        e, f, g, h = (m[step:] for m in (a, b, c, d))
        product = [w * e + x * g, w * f + x * h, y * e + z * g, y * f + z * h]
        scale = 1 / (product[0] + product[1] + product[2] + product[3])
        a, b, c, d = (np.concatenate([m[:step], p * scale]) for m, p in zip((a, b, c, d), product))
        step *= 2
    return [a, b, c, d]


def marginals(potential: np.ndarray, change: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the chances of its labels, and of the pair with the line before (of first lines zeros).

    ``potential`` is the log weight of good over bad, ``change`` the log weights of pairs of labels.
    """
    n = len(text)
    if n == 0:
        return np.zeros((0, 2)), np.zeros((0, 2, 2))
    own = np.stack([1 / (1 + np.exp(np.clip(potential, -30, 30))), 1 / (1 + np.exp(np.clip(-potential, -30, 30)))], axis=1)
    pairs = np.exp(change - change.max())
    first = np.append(True, text[1:] != text[:-1])
    last = np.append(first[1:], True)
    longest = int(np.diff(np.append(np.flatnonzero(first), n)).max())
    # Rows of a first line's matrix are equal: whatever was before, the sums start anew.
    step = [np.where(first, 1.0, pairs[i, j]) * own[:, j] for i in (0, 1) for j in (0, 1)]
    a, b, c, d = _scan(step, longest)
    forward = np.stack([a + c, b + d], axis=1)
    forward /= forward.sum(axis=1, keepdims=True)
    # From behind: what follows a line, for each of its labels. A last line's matrix forgets what is behind it.
    after = np.append(own[1:], own[:1], axis=0)
    step = [np.where(last, 1.0, pairs[i, j] * after[:, j])[::-1] for j in (0, 1) for i in (0, 1)]
    a, b, c, d = (m[::-1] for m in _scan(step, longest))
    backward = np.stack([a + c, b + d], axis=1)
    backward /= backward.sum(axis=1, keepdims=True)
    chances = forward * backward
    chances /= chances.sum(axis=1, keepdims=True)
    joint = np.zeros((n, 2, 2))
    joint[1:] = forward[:-1, :, None] * pairs * (own * backward)[1:, None, :]
    joint[first] = 0
    joint /= np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-300)
    return chances, joint


def fit(levels: np.ndarray, text: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of pairs of labels, from lines with their text's index and label.

    Each text counts by the logarithm of its number of lines, so that long ones don't decide alone.
    """
    columns, spare = _columns(levels, text), len(_NEIGHBOURS) * (_WIDTH + 1)
    lines = np.bincount(text)
    weight = ((1 + np.log(np.maximum(lines, 1))) / np.maximum(lines, 1))[text]
    weight = weight / weight.sum()
    good = labels[text].astype(float)
    inner = np.append(False, text[1:] == text[:-1])
    paired = np.zeros((len(text), 2, 2))
    paired[np.arange(len(text)), good.astype(int), good.astype(int)] = 1
    values, change = np.zeros(spare), np.zeros((2, 2))
    m = v = np.zeros(spare + 4)
    for i in range(1, _ROUNDS + 1):
        chances, joint = marginals(values[columns].sum(axis=1), change, text)
        error = weight * (chances[:, 1] - good)
        slope = np.bincount(columns.ravel(), np.repeat(error, columns.shape[1]), minlength=spare) + _PENALTY * values
        pairs = (weight[:, None, None] * (joint - paired))[inner].sum(axis=0) + 10 * _PENALTY * change
        gradient = np.append(slope, pairs.ravel())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = _RATE * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9) * min(1.0, 2 * (1 - i / (_ROUNDS + 1)))
        values, change = values - move[:spare], change - move[spare:].reshape(2, 2)
    return values, change


class Model:
    """Weights (none if there was nothing to learn) and the share of good documents."""

    def __init__(self, values: np.ndarray | None, change: np.ndarray | None, share: float):
        self.values, self.change, self.share = values, change, share

    def scores(self, texts: list[str]) -> np.ndarray:
        lines = Lines(texts)
        out = np.full(len(texts), self.share)
        if self.values is None or not len(lines.text):
            return out
        chances, _ = marginals(self.values[_columns(lines.levels, lines.text)].sum(axis=1), self.change, lines.text)
        length = np.bincount(lines.text, lines.length, minlength=len(texts))
        good = np.bincount(lines.text, lines.length * chances[:, 1], minlength=len(texts))
        return np.where(length > 0, np.clip(good / np.maximum(length, 1), 0, 1), out)


def fit_model(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
              sample: int = SAMPLE, most_lines: int = MOST_LINES) -> Model:
    """Fit on a sample of the labelled documents that are not held out."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) == 1).alias("good"))
    )
    rows, good = known.agg(F.count(F.lit(1)), F.count_if("good")).first()
    share = (good + 1.5) / (rows + 2)
    if good in (0, rows):
        return Model(None, None, share)
    # The hash keeps about ``sample`` rows, the same ones at every run.
    some = min(1.0, sample / rows)
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(some * 1_000_003) + 1)
    body = text_of(text)
    trained = (
        documents.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
        .where(F.length(body) - F.length(F.replace(body, F.lit("\n"))) < most_lines)
        # At most about ``sample`` short rows.
        .join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("good").alias("good"))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 18):
            lines = Lines(batch.column("text").to_pylist())
            cuts = np.searchsorted(lines.text, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("good"),
                pa.array([lines.levels[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ], names=["doc_id", "good", "levels"])

    schema = T.StructType([*trained.select("doc_id", "good").schema, T.StructField("levels", T.BinaryType())])
    measured = written(map_arrow(trained, measure, schema), "line-measures")

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(batch.column("levels").to_pylist(), batch.column("good").to_pylist())
        found = sorted(row for row in found if row[0])
        if not found:
            return
        counts = [len(raw) // MEASURES for raw, _ in found]
        levels = np.frombuffer(b"".join(raw for raw, _ in found), dtype=np.uint8).reshape(-1, MEASURES)
        values, change = fit(levels, np.repeat(np.arange(len(found)), counts), np.array([g for _, g in found]))
        yield pa.RecordBatch.from_arrays([pa.array([values.tolist()]), pa.array([change.ravel().tolist()])], names=["weights", "pairs"])

    model = map_arrow(measured.select("levels", "good").coalesce(1), fit_rows, "weights array<double>, pairs array<double>").first()
    if model is None:
        return Model(None, None, share)
    return Model(np.array(model.weights), np.array(model.pairs).reshape(2, 2), share)


def with_scores(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """The input without its text and with a score for each row."""
    sent = df.sparkSession.sparkContext.broadcast((model.values, model.change, model.share))
    kept = [c for c in df.columns if c not in (text, score)]
    # The rows travel as one column, so no name of theirs can clash.
    body = df.select(packed(kept).alias("row"), text_of(text).alias("text"))
    schema = T.StructType([body.schema["row"], T.StructField("score", T.DoubleType())])

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*sent.value)
        for batch in slices(batches, "text", 1 << 18):
            scores = fitted.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores)], names=["row", "score"])

    out = map_arrow(body, score_batches, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in kept], F.col("score").alias(score))


def op11_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    model = fit_model(documents, read(spark, folder, "labels"))
    return with_scores(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
