"""Simple-8b word-aligned coding of ids, vectorised both ways.

Every 64-bit word holds a selector in its top four bits and, below, the selector's count of ids in equal
widths. An id of more than 60 bits is an escape: selector 0 and the raw id in the next word. The words
are grouped in blocks of ``BLOCK_WORDS``; the position of each block's first id is stored, so any block
can be decoded without the ones before it.
"""

from __future__ import annotations

import struct

import numpy as np

# Fixed values: (ids per word, bits per id) of selectors 1 to 14, the densest first; selector 0 is the escape.
LAYOUTS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 0
BLOCK_WORDS = 512
MAGIC = b"S8BW"
HEADER = struct.Struct("<4sIQQQ")  # magic, words per block, documents, ids, words
#: Bits of the ids below 2**16, which most vocabularies stay within.
SHORT_BITS = np.frexp(np.arange(2**16, dtype=np.float64))[1].astype(np.uint8)


def _shifts(count: int, bits: int) -> np.ndarray:
    return np.arange(count, dtype=np.uint64) * np.uint64(bits)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, position of the first id of each block). ``ids`` are unsigned 64-bit."""
    n = len(ids)
    padded = np.concatenate([ids, np.zeros(LAYOUTS[0][0], ids.dtype)])
    # Bits of every id; rounding of very large ones can only add one, which at worst costs an escape.
    widest = SHORT_BITS[padded] if padded.max() < 2**16 else np.frexp(padded.astype(np.float64))[1].astype(np.uint8)
    # The densest selector whose ids from here on all fit, from the widest of the next 1, 2, 3, ... 60 ids;
    # the last word may reach past the end.
    selector, before = np.zeros(n, np.uint8), 1
    for number in range(len(LAYOUTS), 0, -1):
        count, bits = LAYOUTS[number - 1]
        if count > before:
            widest, before = np.maximum(widest[:len(widest) - (count - before)], widest[count - before:]), count
        np.copyto(selector, number, where=widest[:n] <= bits)
    steps = np.array([1] + [count for count, _ in LAYOUTS], np.uint8)[selector].tobytes()
    begins, at = bytearray(n), 0
    while at < n:
        begins[at] = 1
        at += steps[at]
    first = np.flatnonzero(np.frombuffer(begins, np.uint8))
    chosen = selector[first]
    # An escape takes two words, the selector and the raw id.
    place = np.arange(len(first)) + np.cumsum(chosen == ESCAPE) - (chosen == ESCAPE)
    words = np.zeros(len(first) + int((chosen == ESCAPE).sum()), np.uint64)
    for number, (count, bits) in enumerate(LAYOUTS, 1):
        here = np.flatnonzero(chosen == number)
        if len(here):
            own, at = np.full(len(here), number << 60, np.uint64), first[here]
            for k in range(count):
                own |= padded[at + k].astype(np.uint64) << np.uint64(k * bits)
            words[place[here]] = own
    raw = np.flatnonzero(chosen == ESCAPE)
    words[place[raw] + 1] = padded[first[raw]]
    owner = np.zeros(len(words), np.int64)
    owner[place] = first
    owner[place[raw] + 1] = first[raw] + 1
    return words, owner[::BLOCK_WORDS]


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of ``words``, which start with a selector."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # A word behind an escape is raw; raw bits may look like another escape, so these go one by one.
    if (selector == ESCAPE).any():
        for at in np.flatnonzero(selector == ESCAPE):
            if not raw[at]:
                raw[at + 1:at + 2] = True
    counts = np.array([1] + [count for count, _ in LAYOUTS] + [0])[selector]
    counts[raw] = 0
    starts = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), np.uint64)
    for number, (count, bits) in enumerate(LAYOUTS, 1):
        here = np.flatnonzero((selector == number) & ~raw)
        if len(here):
            values = (words[here][:, None] >> _shifts(count, bits)) & np.uint64((1 << bits) - 1)
            ids[starts[here][:, None] + np.arange(count)] = values
    # The raw id of an escape in the last word is not here, nor is it asked for.
    escaped = np.flatnonzero((selector[:-1] == ESCAPE) & ~raw[:-1])
    ids[starts[escaped]] = words[escaped + 1]
    return ids[:n]


def write_chunk(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One chunk of a file: header, ids per document, block positions, words; all little-endian."""
    words, blocks = pack(ids)
    head = HEADER.pack(MAGIC, BLOCK_WORDS, len(lengths), len(ids), len(words))
    return b"".join([head, lengths.astype("<u8").tobytes(), blocks.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def _parts(chunk: bytes):
    magic, block_words, documents, n, n_words = HEADER.unpack_from(chunk)
    if magic != MAGIC:
        raise ValueError("not a chunk of packed ids")
    n_blocks = -(-n_words // block_words)
    all_ = np.frombuffer(chunk, "<u8", documents + n_blocks + n_words, HEADER.size)
    return block_words, n, all_[:documents], all_[documents:documents + n_blocks], all_[documents + n_blocks:]


def read_chunk(chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents in a row, ids per document)."""
    _, n, lengths, _, words = _parts(chunk)
    return unpack(words, n), lengths.astype(np.int64)


def read_block(chunk: bytes, block: int) -> tuple[int, np.ndarray]:
    """(position of its first id, ids) of one block, without decoding the others."""
    block_words, n, _, starts, words = _parts(chunk)
    first = int(starts[block])
    after = int(starts[block + 1]) if block + 1 < len(starts) else n
    own = words[block * block_words:(block + 1) * block_words + 1]
    if block and first == after:
        return first, np.zeros(0, np.uint64)
    # A raw word of the block before may come first: it belongs to the escape that the block before ends with.
    if block and _raw_first(words, block * block_words):
        own = own[1:]
    return first, unpack(own, after - first)


def _raw_first(words: np.ndarray, at: int) -> bool:
    """Whether the word at ``at`` is the raw half of an escape, told from where the escape-like words begin."""
    run = at
    while run and int(words[run - 1] >> np.uint64(60)) == ESCAPE:
        run -= 1
    raw = False
    for word in words[run:at]:
        raw = not raw and int(word >> np.uint64(60)) == ESCAPE
    return raw
