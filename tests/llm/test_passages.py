import hashlib
import random

import numpy as np
import pytest

from llm_paths import SF
from lakemart.llm import passages
from lakemart.llm.passages import repeated_passages, windows
from lakemart.llm.runindex import RunLengthIndex, seen_earlier


def brute(rows, depth=100):
    """(id, n_bytes, n_removed, n_spans, kept_sha256) by a table of all strings."""
    rank = lambda key, at: (key is None, key or 0, at)
    texts = [(key, (text or "").encode()) for key, text in rows]
    first = {}
    for key, text in texts:
        for at in range(len(text) - depth + 1):
            string = text[at:at + depth]
            first[string] = min(first.get(string, (True, 1 << 70, 0)), rank(key, at))
    found = []
    for key, text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - depth + 1):
            if first[text[at:at + depth]] < rank(key, at):
                gone[at:at + depth] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone[:len(text)]])
        spans = int((gone[1:] < gone[:-1]).sum())
        found.append((key, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def got(frame):
    return sorted(((row["id"], row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) for row in frame.collect()), key=repr)


def corpus(seed, documents, shared=6):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefé") for _ in range(draw.randrange(1, 8)))
    passage = [" ".join(word() for _ in range(draw.randrange(20, 70))) for _ in range(shared)]
    rows = []
    for i in range(documents):
        parts = [draw.choice(passage) if draw.random() < 0.5 else " ".join(word() for _ in range(draw.randrange(40))) for _ in range(draw.randrange(6))]
        rows.append((draw.randrange(10 * documents), draw.choice([" ", ""]).join(parts)))
    return rows + [(key + 1, text) for key, text in rows[::5]]


HARD = [(1, None), (2, ""), (3, "short"), (4, "ab" * 400), (5, "ab" * 300), (6, "x" * 99), (7, "x" * 100), (8, "x" * 101), (None, "x" * 250),
        (None, "lone " * 30), (9, "é" * 120), (9, "é" * 120), (9, "q" + "é" * 120), (10, "\x00" * 130), (11, "z" + "\x00" * 130)]


@pytest.mark.parametrize("rows", [corpus(1, 60), HARD, corpus(2, 30) + HARD], ids=["shared", "hard", "both"])
def test_repeats(documents, rows):
    assert got(repeated_passages(documents(rows))) == brute(rows)


def test_cut_groups_give_the_same(documents, monkeypatch):
    # One passage in most documents, each with other words around it: the windows at its edges are all different.
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(20)) + " " + passage + " " + " ".join(word() for _ in range(20))) for i in range(60)]
    rows += corpus(4, 20)
    rounds = []
    cut = passages._cut
    monkeypatch.setattr(passages, "_cut", lambda frame, depth, width: rounds.append(width) or cut(frame, depth, width))
    assert got(repeated_passages(documents(rows), group=2, shard_bytes=2000)) == brute(rows)
    assert rounds[:2] == [35, 18] and rounds[-1] == 1


def test_other_depths_and_long_texts_in_stretches(documents, monkeypatch):
    rows = corpus(5, 30)
    assert got(repeated_passages(documents(rows), depth=40, gram=9)) == brute(rows, 40)
    [(raw, ends, *_)] = list(passages.stretches(__import__("pyarrow").RecordBatch.from_pydict({"text": ["a" * 50, "b" * 300]}), 100))
    assert ends.tolist() == [50, 350] and len(raw) == 350
    monkeypatch.setattr(passages, "RUN_BYTES", 130)
    text = " ".join(text for _, text in corpus(6, 8))
    batch = __import__("pyarrow").RecordBatch.from_pydict({"text": [text, "", text[50:400]]})
    seen = set()
    for raw, ends, rows_at, offsets in passages.stretches(batch, 100):
        _, first, count, _ = windows(np.frombuffer(raw, np.uint8), ends, 100, 32)
        which = np.searchsorted(ends, first, "right")
        for a, n, t in zip(first, count, which):
            for at in range(a, a + n):
                place = (int(rows_at[t]), int(offsets[t] + at - np.concatenate([[0], ends])[t]))
                assert place not in seen
                seen.add(place)
    assert seen == {(row, at) for row, one in ((0, text), (2, text[50:400])) for at in range(len(one.encode()) - 99)}


def test_removed_spans_and_kept_bytes(documents):
    rows = corpus(7, 20)
    for row in repeated_passages(documents(rows)).collect():
        assert hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]
        assert sum(span["length"] for span in row["removed"]) == row["n_removed"] and len(row["removed"]) == row["n_spans"]


def test_empty_table(documents):
    assert repeated_passages(documents([])).collect() == []


@pytest.mark.parametrize("depth", [1, 3, 7, 9, 20])
def test_run_length_index(depth):
    draw = random.Random(depth)
    for _ in range(40):
        base = bytes(draw.choice(b"ab\x00\xff") for _ in range(60))
        texts = []
        for _ in range(draw.randrange(1, 12)):
            at = draw.randrange(60)
            texts.append(base[at:at + draw.randrange(40)] + bytes(draw.choice(b"ab") for _ in range(draw.randrange(6))))
        index = RunLengthIndex(texts, depth)
        # Located rows are all suffixes in order, equal ones in the order of their texts.
        text, place = index.located(np.arange(index.size))
        suffixes = [(texts[i][at:], i) for i, at in zip(text, place)]
        assert suffixes == sorted((one[at:], i) for i, one in enumerate(texts) for at in range(len(one) + 1))
        assert len(index.run_first) <= index.size
        ranks = np.array([draw.randrange(5) * 1000 + draw.randrange(30) for _ in texts])
        first = {}
        for one, rank in zip(texts, ranks):
            for at in range(len(one) - depth + 1):
                first[one[at:at + depth]] = min(first.get(one[at:at + depth], 10**9), rank + at)
        wanted = [(i, at) for i, (one, rank) in enumerate(zip(texts, ranks)) for at in range(len(one) - depth + 1) if first[one[at:at + depth]] < rank + at]
        found = seen_earlier(index, ranks)
        assert [(int(i), int(at) + k) for i, at, n in zip(*found) for k in range(n)] == wanted


def test_equal_strings_have_equal_anchors():
    draw = random.Random(8)
    text = bytes(draw.choice(b"abc") for _ in range(400))
    other = bytes(draw.choice(b"abc") for _ in range(150)) + text[60:300] + b"zz"
    place = {}
    for raw in (text, other):
        key, first, count, anchor = windows(np.frombuffer(raw, np.uint8), np.array([len(raw)]), 100, 32)
        assert count.sum() == len(raw) - 99
        for k, a, n, at in zip(key, first, count, anchor):
            for start in range(a, a + n):
                assert place.setdefault(raw[start:start + 100], (k, at - start)) == (k, at - start)


def test_registered_query(spark):
    from lakemart.llm.catalog import QUERIES

    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op12_passage_dedup"].build(spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got(found.withColumnRenamed("doc_id", "id")) == brute(rows)
