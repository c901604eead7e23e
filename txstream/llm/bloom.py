"""A Bloom filter of fixed size, built by Spark and used inside Arrow stages.

The filter only thins out rows before an exact join, so its size (a parameter,
not the data) bounds what is broadcast: when it fills up, more rows pass and are
sorted out by the join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BITS = 24  # 2^24 bits = 2 MiB


def positions(h: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of every 64-bit hash."""
    return h & np.uint64((1 << bits) - 1), (h >> np.uint64(bits)) & np.uint64((1 << bits) - 1)


def build(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter as 64-bit words; at most 2^(bits - 6) rows reach the driver."""
    h = F.col(column)
    mask = F.lit((1 << bits) - 1)
    pos = hashes.where(h.isNotNull()).select(F.explode(F.array(
        h.bitwiseAND(mask), F.shiftrightunsigned(h, bits).bitwiseAND(mask))).alias("p"))
    words = (pos.groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("m")))
    out = np.zeros(1 << (bits - 6), np.uint64)
    got = words.toPandas()
    out[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64).view(np.uint64)
    return out


def contains(filter_words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for every hash that may be in the set (never False for a member)."""
    bits = int(len(filter_words)).bit_length() + 5
    ok = np.ones(len(h), bool)
    for p in positions(h, bits):
        bit = (filter_words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)))
        ok &= (bit & np.uint64(1)).astype(bool)
    return ok
