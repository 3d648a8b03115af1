import re

from llm_paths import SF

from lakemart.llm.licenses import PHRASES, TEMPLATES, Automaton, license_matches, license_report, scan

AUTOMATA = {label: Automaton(template) for label, template in TEMPLATES.items()}


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(label, i) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), places


TEXTS = [
    "", None, "Released under the MIT License.", "cc by nc cc by nc cc-by_nc", "under the mit license under the mit licensed",
    "Licensed under the Apache License, Version 2.0.", "ünder the mit license", "CC BY-NC 4.0 é", "x " * 200_000 + "cc by nc " * 500]


def test_phrases(spark, documents):
    for frame in (spark.read.parquet(f"{SF}/documents.parquet"), documents(list(enumerate(TEXTS)))):
        found = {row["id"]: row for row in license_report(license_matches(frame)).collect()}
        for row in frame.collect():
            n, places = brute(row["text"])
            got, starts = found[row["doc_id"]], [at for _, at in places]
            assert (got["n_words"], got["n_base"]) == (n, len(places))
            assert (got["first_word"], got["last_word"]) == (min(starts, default=None), max(starts, default=None))
            assert got["base_labels"] == ",".join(sorted({label for label, _ in places}))
            assert set(filter(None, got["base_labels"].split(","))) <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


def labels(text):
    return {match["label"] for match in scan(text, AUTOMATA)[1] if not match["base"]}


def test_optional_and_replaceable_regions():
    assert labels("Released under the MIT License. Copyright (c) 2020 Jo Doe") == {"mit-notice"}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3-notice"}
    assert labels("licensed under the terms of the GNU General Public License as published by the Free Software Foundation;"
                  " either version 2 of the License, or (at your option) any later version") == {"gpl-2-notice"}
    assert labels("Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License") == {"cc-by-nc-notice"}


def test_mandatory_wording_must_match_exactly():
    assert labels("licensed under the GNU Lesser General Public License, version 3") == set()
    assert labels("permission is hereby granted free of charge to any person") == set()
    for label, template in TEMPLATES.items():
        whole = re.sub(r"\{\d+\}", "jo", template).replace("[", " ").replace("]", " ")
        bare = template
        while "[" in bare:
            bare = re.sub(r"\[[^\[\]]*\]", " ", bare)
        assert label in labels(whole) and label in labels(bare)
        words = bare.split()
        for i in range(1, len(words) - 1):
            assert label not in labels(" ".join(words[:i] + words[i + 1:])), (label, words[i])


def test_longest_end_and_gap_limit():
    automaton = Automaton("a [b {2}] c")
    assert automaton.match(b"a c".split(), 0) == 2
    assert automaton.match(b"a b x y c".split(), 0) == 5
    assert automaton.match(b"a b x y z c".split(), 0) is None
    assert automaton.match(b"a b c c".split(), 0) == 4


def test_nulls_and_empty_table(documents):
    assert license_report(license_matches(documents([(None, "cc by nc"), (None, "cc by nc")]))).count() == 2
    assert license_matches(documents([])).count() == 0
