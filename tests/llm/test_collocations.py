import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import collocations
from lakemart.llm.collocations import collocations as mine, counted_phrases, scored

LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def brute_counts(rows, longest):
    """{(lang, phrase): n}, {lang: words}"""
    found, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            spoken = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(spoken)
            for size in range(1, longest + 1):
                for at in range(len(spoken) - size + 1):
                    found[lang, " ".join(spoken[at:at + size])] += 1
    return found, {lang: n for lang, n in words.items() if n}


def brute(rows, longest=3, least=10, top=2000, percent=50):
    found, words = brute_counts(rows, longest)
    f = {key: n for key, n in found.items() if n >= least}
    best = {}
    for (lang, phrase), a in f.items():
        spoken = phrase.split(" ")
        cuts = []
        for k in range(1, len(spoken)):
            l, r = f[lang, " ".join(spoken[:k])], f[lang, " ".join(spoken[k:])]  # noqa: E741
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        if cuts:
            best[lang, phrase] = (a, *min(cuts))
    gone = set()
    for (lang, phrase), (a, *_) in best.items():
        spoken = phrase.split(" ")
        for size in range(2, len(spoken)):
            for at in range(len(spoken) - size + 1):
                part = lang, " ".join(spoken[at:at + size])
                if 100 * a >= percent * best[part][0]:
                    gone.add(part)
    per_lang = defaultdict(list)
    for (lang, phrase), (a, score, _, l, r) in best.items():  # noqa: E741
        if (lang, phrase) not in gone:
            per_lang[lang].append((-score, -a, phrase.encode(), phrase, l, r))
    return sorted((lang, rank + 1, phrase, -a, l, r, words[lang], -score)
                  for lang, kept in per_lang.items() for rank, (score, a, _, phrase, l, r) in enumerate(sorted(kept)[:top]))


def texts(seed, documents, vocabulary=12, most=40):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Né", "à b", "X|Y", "<x>"]
    marks = [" "] * 8 + ["  ", "\t", ", ", ". ", "\n", ";", "\x0b"]
    return [(draw.choice(["en", "de", None]), "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randrange(most))))
            for _ in range(documents)]


HARD = [("en", None), (None, ""), ("en", " \t "), ("", "a b a b"), ("en", "A.B!C?"), ("fr", "one two " * 4000), ("en", "lone")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, lang string, text string").selectExpr(
        "*", "1 as phrase", "2 as n", "3 as length", "4 as shard", "5 as first", "6 as a", "7 as rank")


@pytest.mark.parametrize("shards", [1, 3])
def test_counts_over_any_number_of_shards(spark, shards):
    rows = texts(shards, 60)
    # A phrase that only the last documents hold reaches the threshold late and needs a second cycle.
    rows += [("en", "late comers arrive " * 3)] * 5
    counts, languages = counted_phrases(frame(spark, rows).coalesce(1), longest=4, least=5, shards=shards, filter_bits=2**16)
    found, words = brute_counts(rows, 4)
    assert {(row["lang"], row["phrase"]): row["n"] for row in counts.collect()} == {key: n for key, n in found.items() if n >= 5}
    assert {row["lang"]: row["words"] for row in languages.collect()} == words


def test_a_filter_full_of_shared_bits_changes_nothing(spark):
    rows = texts(9, 60)
    counts, _ = counted_phrases(frame(spark, rows), least=4, shards=3, filter_bits=64, slots=2**16)
    found, _ = brute_counts(rows, 3)
    assert {(row["lang"], row["phrase"]): row["n"] for row in counts.collect()} == {key: n for key, n in found.items() if n >= 4}


@pytest.mark.parametrize("rows", [texts(1, 80), HARD * 4, texts(2, 40) + HARD * 10])
def test_phrases(spark, rows):
    got = mine(frame(spark, rows))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(row) for row in got.collect()) == brute(rows)


def test_slots_are_added_up_by_chunk(spark):
    draw = np.random.default_rng(1)
    parts = [draw.integers(0, 3 * collocations.CHUNK, 4000).astype(np.uint64) for _ in range(5)]
    parts[0][:300] = 70_000
    table = __import__("pyarrow").Table.from_batches([collocations._chunked([part]) for part in parts])
    scanned = spark.createDataFrame(table)
    once = collocations._added(scanned, None, 3)
    twice = {row["chunk"]: np.frombuffer(bytes(row["total"]), np.uint8) for row in collocations._added(scanned, once, 3).collect()}
    wanted = np.minimum(2 * np.bincount(np.concatenate(parts).astype(np.int64), minlength=3 * collocations.CHUNK), 3)
    # The first addition stops at 3 as well.
    single = np.minimum(np.bincount(np.concatenate(parts).astype(np.int64), minlength=3 * collocations.CHUNK), 3)
    assert (np.concatenate([twice[i] for i in range(3)]) == np.minimum(single + single, 3)).all() and (wanted >= single).all()
    for row in once.collect():
        bits = np.unpackbits(np.frombuffer(bytes(row["full"]), np.uint8), bitorder="little").astype(bool)
        assert (bits == (single[row["chunk"] * collocations.CHUNK:(row["chunk"] + 1) * collocations.CHUNK] >= 3)).all()


def test_top_and_percent(spark):
    rows = texts(4, 60)
    got = mine(frame(spark, rows), least=3, top=5, inside_percent=80, shards=2)
    assert sorted(tuple(row) for row in got.collect()) == brute(rows, least=3, top=5, percent=80)


def test_a_text_longer_than_a_run(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RUN_BYTES", 100)
    rows = [(lang, text) for lang, text in texts(5, 30, most=200)]
    batch = __import__("pyarrow").array([text.encode() for _, text in rows])
    found = Counter()
    for lang, run in collocations.runs_of([lang or "und" for lang, _ in rows], batch):
        nothing = np.zeros(1, np.uint64)
        for one in collocations.count_run(lang, run, 3, True, collocations.Filters(~nothing, nothing, ~nothing, nothing)):
            if isinstance(one, tuple):
                for phrase, n in zip(one[1].to_pylist(), one[2].tolist()):
                    found[lang, phrase] += n
    assert found == brute_counts(rows, 3)[0]


def test_empty_table(spark):
    assert mine(frame(spark, [])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 5_000_000_029, 4_000_000_007  # noqa: E741
    counts = spark.createDataFrame([(2, "en", "x y", a), (1, "en", "x", l), (1, "en", "y", r)], collocations.COUNTS)
    [row] = scored(counts).collect()
    assert row["score"] == 1_000_000 * a * a // (l * r) and (row["l"], row["r"]) == (l, r)


def test_equal_cuts_go_to_the_shorter_head(spark):
    counts = spark.createDataFrame(
        [(3, "en", "x y z", 10), (2, "en", "x y", 20), (2, "en", "y z", 20), (1, "en", "x", 30), (1, "en", "y", 40), (1, "en", "z", 30)], collocations.COUNTS)
    found = {row["phrase"]: (row["l"], row["r"]) for row in scored(counts).collect()}
    assert found["x y z"] == (30, 20) and counts.where(F.col("n") < 10).isEmpty()
