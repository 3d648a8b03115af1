"""License scan by template-markup matching.

A template is the wording of a license notice in words, with two kinds of regions: ``[ ... ]`` may be
left out, and ``{n}`` stands for up to n words of any kind (a name, a year). It is compiled to an
automaton over words. A text matches where the automaton, started at a word, reaches its end: all
mandatory words are then there, exactly and in order. The words before a template's first region are
looked for first, and the automaton runs only from there.

Besides the templates the scan reports where three fixed phrases stand.

Words are runs of letters a to z (A to Z lower-cased), digits and all characters beyond ASCII.

Defined results: a null text is the empty text, without words and matches; a very long text is scanned whole, word by
word; each row is scanned for
itself; null ids are carried along; of several ends of one match the longest counts; overlapping matches
are all reported and a word they share is covered once; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import name_of, text_of

# Phrase -> label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label -> template, the wording of well-known notices.
TEMPLATES = {
    "apache-2-notice": "licensed under the apache license version 2 0 [the license you may not use this file except in"
        " compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0]",
    "bsd-2-text": "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met [1] redistributions of source code must retain the above copyright"
        " notice this list of conditions and the following disclaimer [2] redistributions in binary form must reproduce"
        " the above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution",
    "cc-by-nc-notice": "licensed under [a] [the] [creative commons attribution noncommercial] [cc by nc] 4 0"
        " [international license]",
    "gpl-2-notice": "licensed under the [terms of the] gnu general public license [as published by the free software"
        " foundation] [either] version 2 [of the license] [or at your option any later version]",
    "gpl-3-notice": "licensed under the [terms of the] gnu general public license [as published by the free software"
        " foundation] [either] version 3 [of the license] [or at your option any later version]",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is"
        " hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction including without"
        " limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the"
        " software and to permit persons to whom the software is furnished to do so subject to the following conditions"
        " the above copyright notice and this permission notice [including the next paragraph] shall be included in all"
        " copies or substantial portions of the software [the software is provided as is without warranty of any kind]",
    "mit-notice": "released under the [terms of the] mit license [copyright [c] {8}]",
    "mpl-2-notice": "this source code form is subject to the terms of the mozilla public license v 2 0 [if a copy of the"
        " mpl was not distributed with this file you can obtain one at {6}]",
}

_TO_WORDS = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128 else 32
    for code in range(256))
MATCHES = "array<struct<label:string,base:boolean,start:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


class Automaton:
    """Steps between numbered states: on one word, on any word, or on none."""

    def __init__(self, template: str):
        tokens = template.replace("[", " [ ").replace("]", " ] ").split()
        self.on_word: list[dict[bytes, int]] = [{}]
        self.on_any: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        opened, at = [], 0
        for token in tokens:
            if token == "[":
                opened.append(at)
            elif token == "]":
                self.free[opened.pop()].append(at)
            elif token.startswith("{"):
                begin = at
                for _ in range(int(token[1:-1])):
                    at = self._state()
                    self.on_any[at - 1] = at
                for state in range(begin, at):
                    self.free[state].append(at)
            else:
                at = self._state()
                self.on_word[at - 1][token.encode()] = at
        if opened:
            raise ValueError("a region of the template is not closed")
        self.end = at
        lead = []
        for token in tokens:
            if token[0] in "[{":
                break
            lead.append(token.encode())
        if not lead:
            raise ValueError("a template begins with a word that must be there")
        #: The words every match begins with.
        self.lead = b" ".join(lead)

    def _state(self) -> int:
        self.on_word.append({})
        self.on_any.append(None)
        self.free.append([])
        return len(self.free) - 1

    def _reached(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def match(self, words: list[bytes], start: int) -> int | None:
        """The greatest word after which a match that begins at ``start`` can end."""
        states, found = self._reached({0}), None
        for at in range(start, len(words) + 1):
            if self.end in states:
                found = at
            if at == len(words) or not states:
                break
            word, after = words[at], set()
            for state in states:
                for step in (self.on_word[state].get(word), self.on_any[state]):
                    if step is not None:
                        after.add(step)
            states = self._reached(after)
        return found


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which the phrase stands; ``joined`` has one blank around every word."""
    wanted, at, word = b" " + phrase + b" ", 0, 0
    found = joined.find(wanted)
    while found >= 0:
        word += joined.count(b" ", at, found)
        yield word
        at, found = found, joined.find(wanted, found + 1)


def scan(text: str | None, automata: dict[str, Automaton]) -> tuple[int, list[dict], int]:
    """(number of words, matches, words that lie in a match)."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    matches = [{"label": label, "base": True, "start": at, "end": at + phrase.count(" ") + 1}
               for phrase, label in PHRASES.items() for at in _places(joined, phrase.encode())]
    for label, automaton in automata.items():
        for at in _places(joined, automaton.lead):
            end = automaton.match(words, at)
            if end is not None:
                matches.append({"label": label, "base": False, "start": at, "end": end})
    covered, upto = 0, 0
    for match in sorted(matches, key=lambda m: (m["start"], m["end"])):
        covered += max(0, match["end"] - max(upto, match["start"]))
        upto = max(upto, match["end"])
    return len(words), matches, covered


def license_matches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    templates: dict[str, str] | None = None) -> DataFrame:
    """Per document: id, n_words, matches (label, base, start, end in words), covered (words in a match)."""
    texts = docs.select(name_of(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    used = TEMPLATES if templates is None else templates
    found = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = {label: Automaton(template) for label, template in used.items()}
        for batch in batches:
            scanned = [scan(text.as_py(), automata) for text in batch.column(1)]
            n_words, matches, covered = ([row[i] for row in scanned] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(matches, found), pa.array(covered, pa.int64())],
                ["id", "n_words", "matches", "covered"])

    return texts.mapInArrow(each, f"id long, n_words long, matches {MATCHES}, covered long")


def license_report(matches: DataFrame) -> DataFrame:
    """The matches of a document in columns; ``score`` is the share of its words that lie in a match."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")

    return matches.select(
        "id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("covered") / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
    )
