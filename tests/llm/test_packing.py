import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_paths import SF

from lakemart.llm import packing, tokens
from lakemart.llm.packing import packed, pieces_of, place, sequences, sum_of_squares
from lakemart.llm.tokens import vocabulary_path


def check(rows, capacity=2048):
    """Every sequence is gapless from 0 and not too long."""
    filled = defaultdict(list)
    for row in rows:
        filled[row["sequence_id"]].append((row["offset"], row["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_each_run_gives_its_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(tokens, "RUN_BYTES", 10)
    monkeypatch.setattr(tokens, "give_back", lambda: given.append(1))
    assert len(list(tokens.encode_runs(pa.array(["some words here"] * 5), None))) == len(given) == 5


def test_pieces_and_sequences_of_every_document(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    whole = packed(pieces_of(frame))
    rows = whole.collect()
    tokenizer, ids = Tokenizer.from_file(vocabulary_path()), {}
    for row in frame.collect():
        ids[row["doc_id"]] = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0], "<u4")
    got = defaultdict(list)
    for row in sorted(rows, key=lambda row: (row["id"], row["piece"])):
        own = ids[row["id"]][row["start"]:row["start"] + row["length"]]
        assert zlib.crc32(own.tobytes()) == zlib.crc32(bytes(row["ids"])) and row["start"] == 2048 * row["piece"]
        got[row["id"]].append(row["length"])
    assert all(sum(got[key]) == len(own) and all(n == 2048 for n in got[key][:-1]) for key, own in ids.items())
    total = sum(map(len, ids.values()))
    assert check(rows) <= -(-total // 2048) + 3
    filled = {row["sequence_id"]: bytes(row["ids"]) for row in sequences(whole).collect()}
    for row in rows:
        assert filled[row["sequence_id"]][4 * row["offset"]:4 * (row["offset"] + row["length"])] == bytes(row["ids"])


def test_many_shards_come_near_one(spark):
    lengths = spark.range(20_000).select(F.col("id").alias("row"), (1 + F.pmod(F.xxhash64("id"), F.lit(1200))).alias("length"))
    total = lengths.agg(F.sum("length")).first()[0]
    rows = lengths.join(place(lengths, shard_rows=1000), "row").collect()
    assert len(rows) == 20_000 and check(rows) <= 1.005 * total / 2048 + 1


def test_pieces_that_never_combine_end_in_bounded_shards(spark, monkeypatch):
    lengths = spark.range(100_000).select(F.col("id").alias("row"), (1100 + F.pmod(F.xxhash64("id"), F.lit(900))).alias("length"))
    written, stored = [], packing.stored
    monkeypatch.setattr(packing, "stored", lambda frame, label: written.append(stored(frame, label)) or written[-1])
    rows = place(lengths, shard_rows=10_000).collect()
    assert len({row["sequence_id"] for row in rows}) == len(rows) == 100_000 and len(written) == 1


def test_rounds_without_gain_end(spark, monkeypatch):
    # Three fit nowhere together and two always do, so dealing them anew saves nothing.
    lengths = spark.range(6_000).select(F.col("id").alias("row"), (700 + F.pmod(F.xxhash64("id"), F.lit(3))).alias("length"))
    shards, stored = [], packing.stored
    monkeypatch.setattr(packing, "stored", lambda frame, label: shards.append(stored(frame, label)) or shards[-1])
    rows = lengths.join(place(lengths, shard_rows=1000), "row").collect()
    assert len(rows) == 6_000 and check(rows) == 3_000
    assert len(shards) <= 2


def test_open_bins_into_which_nothing_fits():
    assert packing.no_more_fits([]) == 1
    assert packing.no_more_fits([(900, 1100), (400, 1500)]) == 901
    assert packing.no_more_fits([(900, 1100), (400, 300), (200, 250)]) == 300


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_sum_of_squares_against_its_definition(sizes):
    sizes = sorted(sizes, reverse=True)
    bins, offsets = sum_of_squares(np.array(sizes, np.int64), 64)
    used, choices = [], []
    for size in sizes:
        fitting = [i for i, n in enumerate(used) if n + size <= 64]
        best = None
        for gap in sorted({64 - used[i] for i in fitting}):
            after = list(used)
            after[next(i for i in fitting if 64 - used[i] == gap)] += size
            counts = defaultdict(int)
            for n in after:
                counts[64 - n] += 1
            score = sum(n * n for g, n in counts.items() if g)
            if best is None or score < best[0]:
                best = (score, gap)
        if best is None:
            used.append(size)
            choices.append(64)
        else:
            used[next(i for i in fitting if 64 - used[i] == best[1])] += size
            choices.append(best[1])
    assert [64 - offset for offset in offsets.tolist()] == choices and len(set(bins.tolist())) == len(used)


def test_nulls_repeats_and_clashing_columns(documents):
    rows = packed(pieces_of(documents([(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "w " * 10_000)]))).collect()
    assert sorted((row["id"], row["length"]) for row in rows if row["id"] not in (None, 3)) == [(1, 3), (1, 3), (2, 1)]
    assert sum(row["length"] for row in rows if row["id"] == 3) == 10_001
    check(rows)


def test_empty_table(documents):
    assert packed(pieces_of(documents([]))).count() == 0
