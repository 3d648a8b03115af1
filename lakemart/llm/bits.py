"""Filters of hash bits: they admit all they were made of, and a little more.

A filter only ever spares work: what it admits is still compared. Its size is bounded by ``most``, so it may be
broadcast at any size of the corpus; a fuller one admits more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: 32 MB.
MOST_BITS = 2**28


def size_for(keys: int, most: int = MOST_BITS) -> int:
    """Bits for so many keys: a power of two, about 16 bits a key."""
    return min(most, max(2**16, 1 << (16 * keys).bit_length()))


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    return hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)


def admitted(hashes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set in ``held`` (64 bits an item)."""
    found = np.ones(len(hashes), bool)
    for bit in places(hashes, len(held) * 64):
        found &= (held[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def with_hashes(held: np.ndarray, hashes: DataFrame) -> np.ndarray:
    """``held`` with the bits of the first column of ``hashes`` (64-bit). Spark joins them per item before they come here."""
    last = len(held) * 64 - 1
    key = F.col(hashes.columns[0])
    bit = hashes.select(F.explode(F.array(key.bitwiseAND(F.lit(last)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(last)))).alias("bit"))
    found = bit.groupBy(F.shiftright("bit", 6).alias("item")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toArrow()
    grown = held.copy()
    grown[found["item"].to_numpy()] |= found["bits"].to_numpy().view(np.uint64)
    return grown


def of_hashes(hashes: DataFrame, keys: int, most: int = MOST_BITS) -> np.ndarray:
    return with_hashes(np.zeros(size_for(keys, most) // 64, np.uint64), hashes)
