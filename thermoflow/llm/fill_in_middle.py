"""Fill-in-the-middle: texts cut in three, the middle moved to the end behind markers.

The bytes of a batch of texts are coded by the class of their character and laid into a
wavelet matrix: one bit plane per bit of the code, each stably sorted by the bit before. How many
characters, words or lines start before a byte is a *rank*: two look-ups per plane. The codes are chosen so that the starts
of each unit are one node of the matrix:

* ``0xx``: a byte that continues a character;
* ``100``: a character inside a word, ``101``: the first one of a word;
* ``110``: a blank, ``111``: a line feed. Blanks are those that separate words.

Ranks at the ends of a text give its number of units (lines start behind line feeds); the byte where unit ``k`` starts is found by
bisection on ranks, for both cuts of all texts of the batch at once. Ranks at the cuts give their
places in characters, whatever the unit.

A text of ``n`` units is cut before the units ``h1 % (n + 1)`` and ``h2 % (n + 1)``, whichever is smaller first; the
numbers come from SHA-256 of the id, so a task that is run again cuts alike. Rows stay in their task: nothing is shuffled.

Null or empty text, or one with a marker in it: form ``plain``, the text as it is (a null one empty), cuts null. Null ids count as empty
ones. Repeated rows give repeated results. Texts of any length are cut whole. Other columns are kept; columns named like a result
(``n, form, prefix_chars, middle_chars, output``) are replaced by it, as is the text's. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from thermoflow.llm.batches import slices
from thermoflow.llm.common import map_arrow, packed, read, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per hundred texts: those that are moved at all, and of these the ones with the suffix first.
MOVED, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Nodes of the matrix: the leading bits of the codes of a unit's starts, and how many bits these are.
UNITS = {"character": (0b1, 1), "word": (0b101, 3), "line": (0b111, 3)}
_BITS = 3
_BLANKS = [0x20, 0x09, 0x0B, 0x0C, 0x0D]


class WaveletMatrix:
    """Ranks over a sequence of small codes."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.size, self._planes = len(codes), []
        for bit in reversed(range(bits)):
            plane = (codes >> bit) & 1 == 1
            padded = np.zeros((len(codes) // 64 + 1) * 64, dtype=bool)
            padded[: len(codes)] = plane
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(words) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:], dtype=np.int64)
            self._planes.append((words, before, len(codes) - int(before[-1])))
            codes = np.concatenate([codes[~plane], codes[plane]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Set bits before each of the positions."""
        at, rest = ends >> 6, (ends & 63).astype(np.uint64)
        return before[at] + np.bitwise_count(words[at] & ((np.uint64(1) << rest) - np.uint64(1)))

    def rank(self, node: tuple[int, int], ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` codes begin with the bits of the node."""
        bits, count = node
        low, high = np.zeros_like(ends), ends
        for depth in range(count):
            words, before, zeros = self._planes[depth]
            ones_low, ones_high = self._ones(words, before, low), self._ones(words, before, high)
            if bits >> (count - 1 - depth) & 1:
                low, high = zeros + ones_low, zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low

    def reach(self, node: tuple[int, int], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least position in ``low .. high`` whose rank is ``wanted`` or more, ``high`` if there is none."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.rank(node, middle) >= wanted
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low


def classes(data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The code of each byte of UTF-8; ``firsts`` are the bytes where texts start."""
    codes = np.full(len(data), 0b100, dtype=np.uint8)
    codes[data & 0xC0 == 0x80] = 0b000
    codes[np.isin(data, _BLANKS)] = 0b110
    codes[data == 0x0A] = 0b111
    # A word starts where a character that is no blank follows one or starts a text.
    after = np.ones(len(data), dtype=bool)
    after[1:] = codes[:-1] >= 0b110
    after[firsts[firsts < len(data)]] = True
    codes[after & (codes == 0b100)] = 0b101
    return codes


class Cuts:
    """The units of a batch of texts, counted and cut."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        self.data = data[offsets[0]: offsets[-1]]
        self.starts, self.ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        self._matrix = WaveletMatrix(classes(self.data, self.starts), _BITS)

    def count(self, unit: str, ends: np.ndarray) -> np.ndarray:
        """Units that start between each text's start and a byte of it."""
        node = UNITS[unit]
        return self._matrix.rank(node, ends) - self._matrix.rank(node, self.starts)

    def units(self, unit: str) -> np.ndarray:
        """Units of each text. Line feeds start lines but the first."""
        n = self.count(unit, self.ends)
        return n + (self.ends > self.starts) if unit == "line" else n

    def before(self, unit: str, k: np.ndarray) -> np.ndarray:
        """The byte where the unit after the first ``k`` ones starts, the text's end if there is none."""
        node = UNITS[unit]
        base = self._matrix.rank(node, self.starts)
        if unit == "line":
            # Behind the k-th line feed.
            return np.where(k == 0, self.starts, self._matrix.reach(node, base + k, self.starts, self.ends))
        # The position with k + 1 starts before it lies one behind the start wanted.
        past = self._matrix.reach(node, base + k + 1, self.starts, self.ends + 1 - (self.ends == len(self.data)))
        found = self._matrix.rank(node, past) >= base + k + 1
        at = np.where(found & (past <= self.ends), past - 1, self.ends)
        return np.where(k == 0, self.starts, at)


def draws(doc_id: Column, count: int = 4, seed: str = "1:") -> list[Column]:
    """Numbers of 32 bits from the id."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def moved(df: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "character") -> DataFrame:
    """The input without its text and with ``n`` (units), ``form, prefix_chars, middle_chars`` and ``output``."""
    added = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ])
    kept = [c for c in df.columns if c not in {text, *added.names}]
    h1, h2, h3, h4 = draws(F.col(doc_id))
    whole = text_of(text)
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    # The rows travel as one column, so no name of theirs can clash.
    body = df.select(
        packed(kept).alias("row"), whole.alias("text"), h1.alias("h1"), h2.alias("h2"),
        F.when((whole == "") | marked | (h3 % 100 >= MOVED), PLAIN).when(h4 % 100 < SUFFIX_FIRST, SPM).otherwise(PSM).alias("form"),
    )
    schema = T.StructType([body.schema["row"], *added])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            cuts = Cuts(batch.column("text"))
            n = cuts.units(unit)
            h = [batch.column(c).to_numpy() % (n + 1) for c in ("h1", "h2")]
            first, second = (cuts.before(unit, k) for k in (np.minimum(*h), np.maximum(*h)))
            forms = batch.column("form").to_pylist()
            plain = np.array([f == PLAIN for f in forms])
            outputs = []
            for form, start, a, b, end in zip(forms, cuts.starts, first, second, cuts.ends):
                parts = (cuts.data[x:y].tobytes() for x, y in ((start, a), (a, b), (b, end)))
                outputs.append(_arranged(form, *(p.decode() for p in parts)))
            prefix = cuts.count("character", first)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(n), batch.column("form"),
                pa.array(prefix, mask=plain), pa.array(cuts.count("character", second) - prefix, mask=plain),
                pa.array(outputs, pa.string()),
            ], names=["row", *added.names])

    out = map_arrow(body, move, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *added.names)


def _arranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == PLAIN:
        return prefix + middle + suffix
    if form == PSM:
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Markers occur once each, as texts that hold one stay plain."""
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    head = F.split_part(output, F.lit(MIDDLE), F.lit(1))
    first = F.when(form == PSM, F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    left, right = (F.split_part(head, first, F.lit(i)) for i in (1, 2))
    opening = F.substring(left, len(PREFIX) + 1, 2**31 - 1)
    return (
        F.when(form == PLAIN, output).when(form == PSM, F.concat(opening, middle, right)).otherwise(F.concat(right, middle, opening))
    )


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    out = moved(read(spark, folder, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def _draw(i: int) -> str:
    return f"('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT"


SQL = f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS digest FROM documents),
cut AS (
  SELECT *, {_draw(0)} % (n + 1) AS x, {_draw(1)} % (n + 1) AS y,
    CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
      OR {_draw(2)} % 100 >= {MOVED} THEN '{PLAIN}' WHEN {_draw(3)} % 100 < {SUFFIX_FIRST} THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM drawn),
parts AS (
  SELECT *, least(x, y) AS a, greatest(x, y) - least(x, y) AS b, left(text, least(x, y)) AS p,
    substr(text, least(x, y) + 1, greatest(x, y) - least(x, y)) AS m, substr(text, greatest(x, y) + 1) AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN a END AS prefix_chars, CASE WHEN form <> '{PLAIN}' THEN b END AS middle_chars,
  sha256(CASE form WHEN '{PLAIN}' THEN text WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
