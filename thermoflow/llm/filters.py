"""Membership filters of a fixed size: which rows can be left out before a shuffle.

A filter may keep rows that it need not; an exact join always follows. So its size is
bounded whatever the data, and a filter that is too full only saves less.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a filter, within these bounds (as powers of two). The upper one is 16 MB.
LEAST_BITS, MOST_BITS = 16, 27


class Membership:
    """A bitmap looked up by 64-bit numbers that are hashes already."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def might_have(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64, copy=False)
        mask = np.uint64(len(self.words) * 64 - 1)
        found = self._is_set(keys & mask)
        hits = np.flatnonzero(found)
        found[hits] = self._is_set((keys[hits] >> np.uint64(34)) & mask)
        return found

    def _is_set(self, position: np.ndarray) -> np.ndarray:
        word = self.words[(position >> np.uint64(6)).view(np.int64)]
        return (word >> (position & np.uint64(63))) & np.uint64(1) != 0


def membership(keys: DataFrame, key: Column, bits_per_key: int = 16) -> Membership:
    """A filter over a column of 64-bit hashes. The bitmap is put together by an aggregation."""
    keys = keys.select(key.alias("key"))
    count = keys.count()
    bits = min(max((bits_per_key * count).bit_length(), LEAST_BITS), MOST_BITS)
    mask = F.lit((1 << bits) - 1)
    positions = keys.select(F.explode(F.array(
        F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 34).bitwiseAND(mask)
    )).alias("position"))
    set_bits = positions.groupBy(F.shiftright("position", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(position & 63 as int))")).alias("bits")
    ).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[set_bits.column("word").to_numpy()] = set_bits.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return Membership(words)
