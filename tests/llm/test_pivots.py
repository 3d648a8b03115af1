import numpy as np
import pytest

from llm_paths import SF

from lakemart.llm import pivots
from lakemart.llm.pivots import near_vectors


def brute(rows, least=0.93):
    rows = [(key, label, None if vector is None else np.array([np.nan if x is None else x for x in vector], float)) for key, label, vector in rows]
    root, links = {key: key for key, _, _ in rows}, {key: 0 for key, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    good = [row for row in rows if row[1] is not None and row[2] is not None and np.isfinite(row[2]).all() and row[2].any()]
    for i, (a, label, one) in enumerate(good):
        for b, other_label, other in good[:i]:
            if label == other_label and len(one) == len(other) and one @ other / np.linalg.norm(one) / np.linalg.norm(other) >= least:
                links[a], links[b] = links[a] + 1, links[b] + 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {key: (links[key], find(key)) for key in root}


def got(frame):
    rows = near_vectors(frame).collect()
    assert all(row["kept"] == (row["id"] == row["component_id"]) for row in rows)
    return {row["id"]: (row["n_links"], row["component_id"]) for row in rows}


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 as node", "2 as row", "3 as weight")


def test_every_vector(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    assert got(frame_of(spark, rows)) == brute(rows)


@pytest.mark.parametrize("block", [2048, 40])
def test_recall_near_the_limit(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    draw = np.random.default_rng(5)
    rows, key = [], 0
    for centre in draw.normal(size=(150, 48)):
        for _ in range(6):
            rows.append((key, int(key % 2), (centre + draw.normal(size=48) * draw.uniform(0, 0.3)).astype(np.float32).tolist()))
            key += 1
    rows += [(key + i, 0, rows[0][2]) for i in range(120)]
    found, wanted = got(frame_of(spark, rows)), brute(rows)
    links = [(found[k][0], wanted[k][0]) for k in wanted]
    assert all(a <= b for a, b in links) and sum(a for a, _ in links) >= 0.97 * sum(b for _, b in links)


def dense_third(draw, count, size, cosine):
    """Unit vectors, a third of them around one centre at about ``cosine`` from each other, shuffled; which those are."""
    third = count // 3
    centre = draw.normal(size=size)
    noise = draw.normal(size=(third, size)) * np.linalg.norm(centre) * np.sqrt((1 - cosine) / cosine / size)
    units = np.vstack([centre + noise, draw.normal(size=(count - third, size))])
    order = draw.permutation(count)
    return (units / np.linalg.norm(units, axis=1, keepdims=True))[order], order < third


@pytest.mark.parametrize("cosine", [0.95, 0.9])
@pytest.mark.parametrize("count, sampled", [(100_000, None), (100_000, pivots.MOST_PIVOTS)])
def test_recall_in_a_dense_third(count, sampled, cosine):
    """The group's first 3000 vectors against each other, by the pivots of all, also by as many as millions have."""
    units, dense = dense_third(np.random.default_rng(6), count, 48, cosine)
    chosen = pivots.spaced(units[-(sampled or pivots.pivot_count(count)):], pivots.LEAST_COSINE)
    group = units[dense][:3000]
    near = pivots.nearest(group, chosen, pivots.PREFIX)
    named = np.zeros((len(group), len(chosen)), np.float32)
    np.put_along_axis(named, near, 1, axis=1)
    linked = np.triu(group @ group.T >= pivots.LEAST_COSINE, 1)
    assert linked.sum() > 100_000 and (named @ named.T >= pivots.SHARED)[linked].mean() >= 0.99


def test_links_of_a_dense_third(spark, monkeypatch):
    monkeypatch.setattr(pivots, "pivot_count", lambda vectors: 1000)
    units, _ = dense_third(np.random.default_rng(7), 1500, 48, 0.95)
    rows = [(key, 1, one.astype(np.float32).tolist()) for key, one in enumerate(units)]
    found, wanted = got(frame_of(spark, rows)), brute(rows)
    assert sum(n for n, _ in found.values()) >= 0.99 * sum(n for n, _ in wanted.values()) > 0


def test_defined_results(spark):
    rows = [
        (1, 1, [1.0, 0.0]), (2, 1, [2.0, 0.0]), (3, 2, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, 1, None), (6, 1, [0.0, 0.0]),
        (7, 1, [float("nan"), 1.0]), (8, 1, [float("inf"), 1.0]), (9, 1, [None, 1.0]), (10, 1, []), (11, 1, [1.0, 0.0, 0.0]),
        (12, 1, [-1.0, 0.0]), (13, 1, [1e-38, 0.0]), (14, 1, [3e38, 0.0])]
    assert got(frame_of(spark, rows)) == brute(rows)
    repeated = near_vectors(frame_of(spark, [(1, 1, [1.0, 0.0])] * 3 + [(None, 1, [1.0, 0.0])])).collect()
    assert sorted((row["n_links"], row["component_id"], row["kept"]) for row in repeated) == [(3, 1, False)] * 3 + [(3, 1, True)]
    assert near_vectors(frame_of(spark, [])).count() == 0
