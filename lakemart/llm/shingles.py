"""Distinct word shingles of whole texts as 64-bit hashes, and their minima under many permutations."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

_LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX[2]
    return values ^ (values >> np.uint64(29))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``width`` words; of all its words where it has fewer.

    Words are separated by white space, A to Z lower-cased. A text without words has no shingles.
    """
    words = word_hashes((text or "").encode().translate(_LOWER).split())
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    found = np.full(count, np.uint64(width))
    for i in range(width):
        found = _mixed(found * MIX[0] + words[i:i + count] * MIX[1])
    return np.unique(found)


@functools.lru_cache(maxsize=4)
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return (draw.integers(0, 2**31, (count, 1), np.uint32) * np.uint32(2) + np.uint32(1),
            draw.integers(0, 2**32, (count, 1), np.uint32))


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """The least value of the set under each of ``count`` permutations of 32-bit numbers.

    The upper halves of the hashes are permuted; ``shingles`` must not be empty.
    """
    factor, shift = _permutations(count)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    # In slices, so that a very long text needs no more memory than a short one.
    for at in range(0, len(values), 4096):
        np.minimum(least, (values[at:at + 4096] * factor + shift).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key of each band of each row of minima."""
    rows = least.reshape(len(least), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for lane in range(rows.shape[2]):
        keys = _mixed(keys * MIX[0] + rows[:, :, lane] * MIX[1])
    return keys.view(np.int64)


def jaccard(one: np.ndarray, other: np.ndarray) -> tuple[int, int]:
    """(size of the intersection, size of the union) of two sorted sets."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both, len(one) + len(other) - both
