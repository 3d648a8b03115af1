import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_paths import SF

from lakemart.llm import minhash
from lakemart.llm.minhash import LANES, estimate, keep_first, least_lanes, near_duplicates
from lakemart.llm.shingles import jaccard, minima, shingle_set

LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))


def shingles(text, width):
    words = (text or "").encode().translate(LOWER).split()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def brute(rows, width, percent=80):
    """(set size, smallest id reachable) per id, comparing all pairs."""
    sets = {key: shingles(text, width) for key, text in rows}
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(key for key in sets if sets[key])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {key: (len(sets[key]), find(key)) for key in sets}


def got(frame, **options):
    return {row["id"]: (row["n_shingles"], row["component_id"]) for row in near_duplicates(frame, **options).collect()}


@pytest.mark.parametrize("width", [2, 5])
def test_every_document(spark, width):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(frame, width=width) == brute([(row["doc_id"], row["text"]) for row in frame.collect()], width)


def near_copies(count, seed):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(500)}" for _ in range(80)]
    texts = []
    for _ in range(count):
        words = list(base)
        for _ in range(draw.randrange(9)):
            words[draw.randrange(len(words))] = f"v{draw.randrange(10_000)}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("rounds", [0, 2])
def test_groups_of_near_copies(documents, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 6)
    rows = list(enumerate(near_copies(90, 1) + near_copies(40, 2) + ["other words " * 30]))
    assert got(documents(rows), width=2, hub_rounds=rounds) == brute(rows, 2)


def test_tasks_hold_two_blocks_of_a_template(spark, monkeypatch):
    """Pages of one template that link with nothing: all of them are outside the largest component."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = spark.range(400).selectExpr("7L as key", "id as node", "id as component", "399L as group", "16 as size")
    blocks = minhash._blocked(rows, "key", F.col("component") != F.col("group"))
    task = [name for name in ("x", "y", "block") if name in blocks.columns][:2]
    assert blocks.groupBy(*task).count().agg(F.max("count")).first()[0] <= 4 * 16
    pairs = blocks.select("x", "y", "block", "node").toPandas()
    met = set()
    for (x, y), part in pairs.groupby(["x", "y"]):
        met |= {frozenset((a, b)) for a in part[part.block == x].node for b in part[part.block == y].node if a != b}
    assert len(met) == 400 * 399 // 2


def test_blocks_of_long_sets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SIZE", 1000)
    rows = spark.range(200).selectExpr("7L as key", "id as node", "id as component", "199L as group", "100 as size")
    blocks = minhash._blocked(rows, "key", F.col("component") != F.col("group"))
    assert blocks.groupBy("x", "y").count().agg(F.max("count")).first()[0] <= 4 * 10


def test_defined_results(documents):
    frame = documents([(1, None), (2, ""), (3, "one"), (4, "ONE"), (5, "a b"), (6, "a\tb"), (7, "a b c"), (None, "a b"), (7, "a b c"),
                       (8, "q " * 100_000)])
    rows = near_duplicates(frame, width=2).collect()
    assert sorted([(row["id"], row["n_shingles"], row["component_id"], row["kept"]) for row in rows], key=repr) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False), (5, 1, 5, True), (6, 1, 5, False), (None, 1, 5, False),
        (7, 2, 7, True), (7, 2, 7, False), (8, 1, 8, True)], key=repr)
    kept = keep_first(frame, width=2)
    assert kept.columns == frame.columns and sorted(row["doc_id"] for row in kept.collect()) == [1, 2, 3, 5, 7, 8]
    assert near_duplicates(documents([])).count() == 0 and keep_first(documents([])).count() == 0


def test_estimate_is_near_the_similarity():
    errors = []
    for a, b in zip(near_copies(60, 4), near_copies(60, 4)[1:]):
        one, other = (shingle_set(text, 2) for text in (a, b))
        both, either = jaccard(one, other)
        equal = (minima(one, LANES).astype(np.uint8) == minima(other, LANES).astype(np.uint8)).sum()
        errors.append(estimate(equal) - both / either)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    assert least_lanes(80) < LANES * 0.7
