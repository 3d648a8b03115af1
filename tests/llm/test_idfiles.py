import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from llm_paths import SF

from lakemart.llm import tokens
from lakemart.llm.idfiles import read_ids, write_ids
from lakemart.session import scratch_path


def round_trip(spark, frame):
    path = scratch_path(spark, "ids")
    write_ids(frame, path)
    return read_ids(spark, path).collect()


def test_files_of_every_document(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {row["id"]: row for row in round_trip(spark, frame)}
    tokenizer, before = Tokenizer.from_file(tokens.vocabulary_path()), 0
    for row in sorted(frame.collect()):
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        got = rows[row["doc_id"]]
        assert (got["start"], got["n_tokens"]) == (before, len(ids))
        assert zlib.crc32(bytes(got["ids"])) == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)


def test_nulls_repeats_and_empty(spark, documents):
    rows = round_trip(spark, documents([(5, "a"), (5, "a"), (None, "b b"), (1, None), (7, "long " * 300_000)]))
    got = sorted((row["start"], row["id"], row["n_tokens"]) for row in rows)
    assert got == [(0, None, 3), (3, 1, 1), (4, 5, 2), (6, 5, 2), (8, 7, 300_001)]
    assert round_trip(spark, documents([])) == []


PARTS = ["a", "B", "'s", "'LL", "é", "É", "é", "É", "ẖ", "H̱", " ", "  ", "\n", "\x0b", "\x1c", "\x85", "\xa0", " ",
         "1", "23", "!", ".", ",", ". ", "%%% ", "<|endoftext|>", "<|ENDOFTEXT|>", "Σ", "İ", "ſ", "ß", "日本", "\U0001F600", "\x00", "﻿"]


def test_memo_gives_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 2000)
    monkeypatch.setattr(tokens, "RUN_BYTES", 4000)
    draw = random.Random(7)
    texts = [None, ""] + ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(5000)]
    plain = Tokenizer.from_file(tokens.vocabulary_path()).encode_batch([text or "" for text in texts], add_special_tokens=False)
    seen = 0
    for first, ids, counts in tokens.encode_runs(pa.array(texts), None):
        assert first == seen
        for i, part in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            assert part.tolist() == plain[first + i].ids, texts[first + i]
        seen += len(counts)
    assert seen == len(texts)


def test_a_full_memo_keeps_what_came_again(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 100)
    memo = tokens.ChunkEncoder(tokens.vocabulary_path())
    common = [f"{a}{b}" for a in "abcdef" for b in "ghijk"]
    rare = [f"zz{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    for text in (common, common, rare[:60], rare[60:]):
        memo.run([" ".join(text).encode()])
    asked = []
    monkeypatch.setattr(memo, "_by_library", lambda texts, real=memo._by_library: asked.append(texts) or real(texts))
    ids, _ = memo.run([" ".join(common).encode()])
    assert asked == [] and len(memo.half) <= 100
    assert ids.tolist() == memo.tokenizer.encode(" ".join(common), add_special_tokens=False).ids


def test_new_words_go_to_the_library_together(monkeypatch):
    memo, asked = tokens.ChunkEncoder(tokens.vocabulary_path()), []
    monkeypatch.setattr(memo, "_by_library", lambda texts, real=memo._by_library: asked.extend(texts) or real(texts))
    text = " ".join(f"wörd{a}{b}ß, q{a}.{b}@x" for a in "abcdefgh" for b in "ijklmnop")
    ids, counts = memo.run([b"", text.encode(), b"  "])
    plain = memo.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == plain and counts.tolist() == [0, len(plain), 0]
    assert len(asked) < 90  # 129 words, 73 marks with or without letters behind them
    assert [len(part) for part in memo.run([b""])] == [0, 1]
