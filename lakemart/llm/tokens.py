"""Token ids of whole texts, encoded word by word with a memo.

Only for a vocabulary of lower-cased words that drops white space, like the default one: no token
crosses it, so the ids of a text are the ids of its blank-separated chunks put together. A chunk is
encoded by the tokenizers library once and then looked up; texts of one corpus repeat their words, so
most chunks are look-ups.

The memo of a worker holds 128-bit digests of chunks and their ids in sorted arrays, about 40 bytes a chunk, so it stays
below 32 MB. It outlives the task, as most words of one task come in the next one of the worker too. Once it is full, the chunks
that came only once since it was full before make room.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are encoded in runs of about this many bytes, so a batch of long texts needs no more memory.
RUN_BYTES = 2 * 2**20
#: Chunks that the memo holds at most.
MEMO_CHUNKS = 600_000
#: Chunks that the library encodes at once; its own result objects are large.
LEARNT_AT_ONCE = 8192
#: Words that are put together for the library, as its work a text is much of that for a word.
WORDS_A_TEXT = 64
#: Longer chunks are encoded but not remembered.
LONGEST_CHUNK = 64


def vocabulary_path() -> str:
    """The default vocabulary, where this machine has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Letters (ASCII and the two-byte ones of Latin-1) alone, and with punctuation other than the apostrophe behind them.
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
WORD = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]+)")
#: Per byte: whether it is punctuation other than the apostrophe, a small letter, the second byte of a small letter of Latin-1.
MARK, SMALL, SECOND = (np.array([bool(re.match(kind, bytes([byte]))) for byte in range(256)]) for kind in (
    rb"[!-&(-/:-@\[-`{-~]", rb"[a-z]", rb"[\xa0-\xb6\xb8-\xbf]"))
MARKS = frozenset(np.flatnonzero(MARK).tolist())
#: A special token, or the first byte of a mark that composes with a letter.
AS_IT_IS = (b"<|", b"\xcc", b"\xcd")


def _plain(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of texts with the same ids and fewer different chunks, in a row; where each begins, and the end).

    The tokenizer lower-cases, and always splits between a letter and punctuation. Not so within special
    tokens, and lower-casing first could change which marks compose: such texts stay as they are.
    """
    stays = np.array([any(sign in text for sign in AS_IT_IS) for text in texts], bool)
    joined = b"".join([text if same else text.lower() for text, same in zip(texts, stays.tolist())])
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    raw = np.frombuffer(joined, np.uint8)
    marks = np.flatnonzero(MARK[raw])
    before = raw[marks - 1]
    marks = marks[SMALL[before] | (SECOND[before] & (raw[marks - 2] == 0xC3))]
    owner = np.searchsorted(ends, marks, "right") - 1
    # The letter is of the same text.
    cut = marks[~stays[owner] & (ends[owner] < marks)]
    return np.insert(raw, cut, 0x20), ends + np.searchsorted(cut, ends)


def _units(chunk: bytes) -> tuple[bytes, ...]:
    """Parts whose ids put together are the chunk's ids: the word and the punctuation behind it."""
    word = WORD.fullmatch(chunk) if chunk and chunk[-1] in MARKS else None
    return (word[1], word[2]) if word else (chunk,)


def _values(chunks: pa.LargeStringArray) -> list[bytes]:
    """The bytes of every chunk, none of which is null."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:chunks.offset + len(chunks) + 1].tolist()
    data = chunks.buffers()[2].to_pybytes() if offsets and offsets[-1] else b""
    return [data[start:end] for start, end in itertools.pairwise(offsets)]


def _digests(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(chunk) for chunk in chunks]), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _gathered(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretches of ``flat`` in a row, the position behind each)."""
    upto = np.concatenate([[0], np.cumsum(length)])
    return flat[np.repeat(first - upto[:-1], length) + np.arange(upto[-1])], upto


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Whether an id ends a word, for vocabularies that tell.
        self.last = None
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        # A digest's first half, in order, its second half, and where its ids are in ``flat``.
        self.half, self.other = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        # Whether it came again since the memo was full.
        self.again = np.zeros(0, bool)

    def _make_room(self) -> None:
        """Leave out the chunks that came only once, or all where most came again."""
        kept = np.flatnonzero(self.again)
        if len(kept) > MEMO_CHUNKS // 2:
            self.forget()
            return
        self.flat, upto = _gathered(self.flat, self.first[kept], self.length[kept])
        self.half, self.other, self.first, self.length = self.half[kept], self.other[kept], upto[:-1], self.length[kept]
        self.again = np.zeros(len(kept), bool)

    def _known(self, half: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The place of each digest in the memo, -1 where it is not there."""
        if not len(self.half):
            return np.full(len(half), -1)
        at = np.minimum(np.searchsorted(self.half, half), len(self.half) - 1)
        return np.where((self.half[at] == half) & (self.other[at] == other), at, -1)

    def _by_library(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts in a row, ids per text)."""
        found = [one.ids for one in self.tokenizer.encode_batch_fast([text.decode() for text in texts], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters alone, several to a text: their last ids tell where each ends."""
        ids, _ = self._by_library([b" ".join(words[at:at + WORDS_A_TEXT]) for at in range(0, len(words), WORDS_A_TEXT)])
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(words) or ends[-1] != len(ids) - 1:
            return self._by_library(words)
        return ids, np.diff(ends, prepend=-1)

    def _encoded(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(ids of the units in a row, ids per unit, the units in that order), by the library."""
        words, others = [], units
        if self.last is not None:
            words, others = [], []
            for unit in units:
                (words if LETTERS.fullmatch(unit) else others).append(unit)
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for encode, own in ((self._words, words), (self._by_library, others)):
            for at in range(0, len(own), LEARNT_AT_ONCE):
                found, counts = encode(own[at:at + LEARNT_AT_ONCE])
                ids.append(found)
                lengths.append(counts)
        return np.concatenate(ids), np.concatenate(lengths), words + others

    def _stretches(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, first id and number of ids of each chunk); new chunks go into the memo."""
        half, other = _digests(chunks)
        known = self._known(half, other)
        new = np.flatnonzero(known < 0)
        # Words and the punctuation behind them are learnt on their own, and once.
        split = [_units(chunks[i]) for i in new.tolist()]
        units = sorted({unit for one in split for unit in one})
        unit_half, unit_other = _digests(units)
        unit_known = self._known(unit_half, unit_other)
        unknown = np.flatnonzero(unit_known < 0)
        place = dict(zip(units, range(len(units))))
        ids, lengths, learnt = self._encoded([units[i] for i in unknown.tolist()])
        unknown = np.fromiter((place[unit] for unit in learnt), np.int64, len(learnt))
        flat = np.concatenate([self.flat, ids])
        unit_first, unit_length = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        old = unit_known >= 0
        unit_first[old], unit_length[old] = self.first[unit_known[old]], self.length[unit_known[old]]
        unit_first[unknown], unit_length[unknown] = len(self.flat) + np.cumsum(lengths) - lengths, lengths
        parts = np.fromiter((place[unit] for one in split for unit in one), np.int64)
        owner = np.repeat(np.arange(len(split)), np.fromiter(map(len, split), np.int64, len(split)))
        joined, _ = _gathered(flat, unit_first[parts], unit_length[parts])
        new_length = np.bincount(owner, unit_length[parts], len(split)).astype(np.int64)
        first, length = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        seen = known >= 0
        self.again[known[seen]] = self.again[unit_known[old]] = True
        first[seen], length[seen] = self.first[known[seen]], self.length[known[seen]]
        first[new], length[new] = len(flat) + np.cumsum(new_length) - new_length, new_length
        flat = np.concatenate([flat, joined])
        self._remember(
            flat, np.concatenate([unit_half[unknown], half[new]]), np.concatenate([unit_other[unknown], other[new]]),
            np.concatenate([unit_first[unknown], first[new]]), np.concatenate([unit_length[unknown], new_length]),
            np.fromiter(itertools.chain((len(units[i]) for i in unknown.tolist()), (len(chunks[i]) for i in new.tolist())), np.int64))
        return flat, first, length

    def _remember(self, flat: np.ndarray, half: np.ndarray, other: np.ndarray, first: np.ndarray, length: np.ndarray, size: np.ndarray) -> None:
        """Take in the digests of chunks that are short enough, without their repeats."""
        short = size <= LONGEST_CHUNK
        half, at = np.unique(half[short], return_index=True)
        other, first, length = other[short][at], first[short][at], length[short][at]
        fresh = self._known(half, other) < 0
        half, other, first, length = half[fresh], other[fresh], first[fresh], length[fresh]
        if len(self.half) + len(half) > MEMO_CHUNKS:
            self._make_room()
            if len(self.half) + len(half) > MEMO_CHUNKS:
                return
        ids, upto = _gathered(flat, first, length)
        into = np.searchsorted(self.half, half)
        self.half, self.other = np.insert(self.half, into, half), np.insert(self.other, into, other)
        self.first = np.insert(self.first, into, len(self.flat) + upto[:-1])
        self.length, self.again = np.insert(self.length, into, length), np.insert(self.again, into, False)
        self.flat = np.concatenate([self.flat, ids])

    def run(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text)."""
        plain, ends = _plain(texts)
        joined = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(plain))
        split = pc.ascii_split_whitespace(joined)
        # Each different chunk of the run is looked up once; the empty ones at the ends of texts have no ids.
        coded = split.flatten().dictionary_encode()
        flat, first, length = self._stretches(_values(coded.dictionary))
        places = coded.indices.to_numpy()
        ids, upto = _gathered(flat, first[places], length[places])
        return ids, np.diff(upto[split.offsets.to_numpy()])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def give_back() -> None:
    """Free memory that the allocators of this worker keep goes back to the machine.

    Arrow's pool and the C library hold on to it otherwise, next to what the worker still uses.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


@contextlib.contextmanager
def released() -> Iterator[None]:
    """Around a task that encodes: what its texts took goes back to the machine, the bounded memo stays."""
    try:
        yield
    finally:
        give_back()


def encode_runs(texts: pa.Array, path: str | None):
    """Yields (position of the first text, ids of a run of texts in a row, ids per text).

    A null text is the empty text, and an empty text has no ids.
    """
    memo = encoder(path or vocabulary_path())
    run, size, first = [], 0, 0
    for i, text in enumerate(texts):
        raw = (text.as_py() or "").encode()
        run.append(raw)
        size += len(raw)
        if size >= RUN_BYTES or i == len(texts) - 1:
            ids, counts = memo.run(run)
            run, size = [], 0
            give_back()
            yield first, ids, counts
            first = i + 1
