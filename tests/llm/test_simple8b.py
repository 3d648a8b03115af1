import numpy as np
from hypothesis import given, settings, strategies as st

from lakemart.llm.simple8b import ESCAPE, pack, read_block, read_chunk, unpack, write_chunk

ids = st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300)


@settings(max_examples=200, deadline=None)
@given(ids)
def test_round_trip(values):
    values = np.array(values, np.uint64)
    words, _ = pack(values)
    assert unpack(words, len(values)).tolist() == values.tolist()


def test_dense_runs_take_few_words():
    assert len(pack(np.ones(600, np.uint64))[0]) == 10
    assert len(pack(np.full(300, 40_000, np.uint64))[0]) == 100


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 6000))
def test_every_block_by_itself(seed, n):
    draw = np.random.default_rng(seed)
    values = draw.integers(0, 2**63, n, np.uint64) >> draw.integers(0, 64, n).astype(np.uint64)
    values[draw.random(n) < 0.05] = np.uint64(2**64 - 1)
    values[draw.random(n) < 0.05] = np.uint64(2**59)
    lengths = np.array([n // 3, n - n // 3])
    chunk = write_chunk(values, lengths)
    got, counts = read_chunk(chunk)
    assert got.tolist() == values.tolist() and counts.tolist() == lengths.tolist()
    words, starts = pack(values)
    whole = []
    for block in range(len(starts)):
        first, part = read_block(chunk, block)
        assert first == len(whole)
        whole += part.tolist()
    assert whole == values.tolist()


def test_empty_chunk_and_escape():
    got, counts = read_chunk(write_chunk(np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    assert len(got) == 0 and len(counts) == 0
    assert int(pack(np.array([2**60], np.uint64))[0][0] >> np.uint64(60)) == ESCAPE
