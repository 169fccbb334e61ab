"""Filters of 64-bit keys, of at most a fixed size, that let every given key pass and few others.

A filter spares a shuffle what a join would drop anyway; the join itself decides. It grows with the keys up to
``MOST_BITS`` (8 MB) and no further: with very many keys it lets more others pass, and results stay the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26
BITS_PER_KEY = 48
_SHIFTS = (0, 19, 38)


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """The filter of the distinct values of ``key``, as 64-bit words; a power of two of them."""
    spread = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    bits = LEAST_BITS
    total = spread.count()
    while bits < min(MOST_BITS, BITS_PER_KEY * total):
        bits *= 2
    places = spread.select(F.explode(F.array(*[F.expr(f"shiftrightunsigned(key, {s}) & {bits - 1}L") for s in _SHIFTS])).alias("place"))
    words = places.groupBy(F.expr("shiftright(place, 6)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    out = np.zeros(bits // 64, np.uint64)
    found = words.toArrow()
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indices of the keys (uint64) that may be among the filter's."""
    mask = np.uint64(len(words) * 64 - 1)
    left = np.arange(len(keys))
    for shift in _SHIFTS:
        place = (keys[left] >> np.uint64(shift)) & mask
        left = left[(words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0]
    return left
