"""Helpers for functions over Arrow batches: small slices, and hashes of words and texts.

All hashes are 64-bit numbers from fixed constants, so every executor, also a later one
that repeats a lost task, gets the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
#: An odd multiplier and its use for polynomial hashes modulo 2**64.
BASE = _U(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(np.asarray(
            pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
        ))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on every bit of the input."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def powers(count: int, base: np.uint64 = BASE) -> np.ndarray:
    """``base ** 0 .. base ** (count - 1)`` modulo 2**64."""
    out = np.full(max(count, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:count]


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of a column of texts, flattened.

    ``hashes`` has one number per word, ``first`` the index of each text's first word (and
    one entry more at the end), ``starts`` and ``ends`` the words' bytes in ``data``.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        self.data = data[offsets[0]: offsets[-1]]
        offsets = offsets - offsets[0]
        inside = ~_BLANK[self.data]
        # A word starts where a byte follows a blank or starts a text.
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        borders = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens[borders] = inside[borders]
        self.starts = np.flatnonzero(opens)
        # It ends before the next blank, the next start or the end.
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        tails = borders[1:] - 1 if len(borders) else borders
        closes[tails] = inside[tails]
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        lengths = self.ends - self.starts
        if len(lengths) == 0:
            self.hashes = np.zeros(0, dtype=np.uint64)
            return
        values = _BYTE_VALUES[self.data[inside]]
        runs = np.cumsum(lengths) - lengths
        position = np.arange(len(values)) - np.repeat(runs, lengths)
        values *= powers(int(lengths.max()))[position]
        self.hashes = mixed(np.add.reduceat(values, runs) + lengths.astype(np.uint64))

    def text_index(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, by the index of its first word."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        total *= BASE
        total += hashes[i: i + count]
    return mixed(total)
