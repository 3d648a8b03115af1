"""A run-length index of a set of texts: the runs of their Burrows-Wheeler transform with sampled run ends.

Every text ends with a mark of its own, smaller than all bytes and ordered like the texts. The rows of the
transform are the suffixes in order; the index holds of each run of equal symbols its first row, the row
that row leads to when a text is read one symbol backwards, and the place in the texts of its last row. In texts that
repeat each other the runs are few. ``depth`` adds where neighbouring rows part before that many symbols: rows
between two such breaks are the suffixes that begin with the same ``depth`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Symbols (bytes and the mark) take 9 bits, seven fit a number.
PACKED = 7


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


class RunLengthIndex:
    def __init__(self, texts: list[bytes], depth: int):
        self.depth = depth
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.lengths + 1)])[:-1]
        symbols = np.zeros(int((self.lengths + 1).sum()), np.int64)
        marks = self.first + self.lengths
        inside = np.ones(len(symbols), bool)
        inside[marks] = False
        symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        #: Symbols before the text's mark, from each place on.
        left = np.repeat(marks, self.lengths + 1) - np.arange(len(symbols))
        order, same = self._sorted(symbols, left)

        before = symbols[order - 1]
        before[order == 0] = 0
        starts = np.concatenate([[True], before[1:] != before[:-1]]) | (before == 0)
        self.run_first = np.flatnonzero(starts)
        self.run_symbol = before[self.run_first]
        sizes = np.diff(np.append(self.run_first, len(symbols)))
        self.run_last_place = order[self.run_first + sizes - 1]
        # Reading backwards keeps the order of rows with the same symbol before them.
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        self.run_leads = np.empty(len(sizes), np.int64)
        self.run_leads[by_symbol] = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        self.breaks = np.flatnonzero(np.concatenate([[True], ~same]))
        self.size = len(symbols)

    def _sorted(self, symbols: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the order of their suffixes, whether a row and the one before begin with the same ``depth`` bytes).

        By doubling: ranks of the first h symbols give those of the first 2 h. Suffixes equal to their marks
        keep the order of the texts.
        """
        size, places = len(symbols), np.arange(len(symbols))

        def further(values: np.ndarray, step: int) -> np.ndarray:
            """The value ``step`` places on, 0 behind the mark."""
            return np.where(left >= step, values[np.minimum(places + step, size - 1)], 0)

        h = min(PACKED, self.depth)
        keys = np.zeros(size, np.int64)
        for step in range(h):
            keys = (keys << 9) | further(symbols, step)
        ranks = _dense(keys)
        longest = int(self.lengths.max(initial=0)) + 1
        part, covered = ranks, h
        order = None
        while h < longest:
            keys = ranks * (size + 1) + further(ranks + 1, h)
            h *= 2
            if h >= longest and h > self.depth and size < 2**20:
                # The last round needs no ranks, and keys that end with the place are never equal.
                order = np.argsort(keys * size + places)
                break
            ranks = _dense(keys)
            if h <= self.depth:
                part, covered = ranks, h
        if order is None:
            order = np.argsort(ranks * size + places)
        # Two overlapping stretches of known rank make up the first ``depth`` symbols.
        head, tail, whole = part[order], further(part, self.depth - covered)[order], (left >= self.depth)[order]
        return order, (head[1:] == head[:-1]) & (tail[1:] == tail[:-1]) & whole[1:] & whole[:-1]

    def streamed(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, place in the text, group) of every suffix of ``depth`` bytes or more, all texts read backwards side by side."""
        texts = np.argsort(-self.lengths, kind="stable")
        rows = texts.copy()
        # Every row is passed once, so the runs and groups are unrolled for the while.
        leads = np.repeat(self.run_leads - self.run_first, np.diff(np.append(self.run_first, self.size)))
        group = np.repeat(np.arange(len(self.breaks)), np.diff(np.append(self.breaks, self.size)))
        for step in range(1, int(self.lengths.max(initial=0)) + 1):
            texts = texts[:np.searchsorted(-self.lengths[texts], -step, "right")]
            rows = rows[:len(texts)]
            rows = rows + leads[rows]
            if step >= self.depth:
                yield texts, self.lengths[texts] - step, group[rows]

    def located(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, place in it) of each row: backwards to the next sampled run end."""
        rows, steps, found = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1)
        todo = np.arange(len(rows))
        while len(todo):
            run = np.searchsorted(self.run_first, rows[todo], "right") - 1
            last = np.append(self.run_first[1:], self.size)[run] - 1
            ends = rows[todo] == last
            found[todo[ends]] = self.run_last_place[run[ends]] + steps[todo[ends]]
            todo, run = todo[~ends], run[~ends]
            rows[todo] = self.run_leads[run] + rows[todo] - self.run_first[run]
            steps[todo] += 1
        text = np.searchsorted(self.first, found, "right") - 1
        return text, found - self.first[text]


def seen_earlier(index: RunLengthIndex, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first place, places) of the stretches of places whose next ``depth`` bytes also begin at an earlier rank.

    ``ranks`` has the rank of each text's first place; its later places count on from there.
    """
    found = list(index.streamed())
    if not found:
        return (np.zeros(0, np.int64),) * 3
    text, place, group = (np.concatenate(column) for column in zip(*found))
    rank = ranks[text] + place
    earliest = np.full(len(index.breaks), np.iinfo(np.int64).max)
    np.minimum.at(earliest, group, rank)
    again = earliest[group] < rank
    text, place = text[again], place[again]
    order = np.lexsort((place, text))
    text, place = text[order], place[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (np.diff(place) != 1)])) if len(text) else np.zeros(0, np.int64)
    return text[starts], place[starts], np.diff(np.append(starts, len(text)))
