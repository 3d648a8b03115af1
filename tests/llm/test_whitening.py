import numpy as np
import pytest

from llm_paths import SF
from lakemart.llm import whitening


def brute(vectors, wanted=8):
    """(x, n, deviations, eigenvalues, eigenvectors) of the usable vectors, by a full eigendecomposition."""
    x = [[int(np.floor(1024 * float(np.float64(c)))) + 100_000 for c in vector] for vector in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return centred, n, deviation, values[::-1][:wanted], axes[:, ::-1][:, :wanted]


def check(frame, vectors, wanted=8, close=1e-9):
    """``vectors``: id -> entries. Returns the rows by id and component."""
    centred, n, deviation, values, axes = brute(list(vectors.values()), wanted)
    got = {(row["id"], row["component"]): row for row in frame.collect()}
    count = min(wanted, int((values > values[0] * 1e-13).sum()))
    assert sorted(got) == sorted((key, i + 1) for key in vectors for i in range(count))
    trace = (centred**2).sum() / n
    out = np.array([[got[key, i + 1]["whitened"] for i in range(count)] for key in vectors])
    for i in range(count):
        wanted_out = centred @ axes[:, i] / np.sqrt(values[i])
        sign = np.sign(out[:, i] @ wanted_out)
        assert np.abs(sign * out[:, i] - wanted_out).max() < close
    for key, exact in zip(vectors, deviation):
        row = got[key, 1]
        assert int(row["deviation"]) == exact and row["n"] == n and row["identity_error"] < 1e-10
        assert row["explained"] == pytest.approx(values[0] / trace, rel=1e-10)
    return out


def test_random_and_stretched(spark):
    random = np.random.default_rng(1)
    vectors = {i: list(map(float, row)) for i, row in enumerate(random.normal(size=(300, 12)) * 3.0 ** -np.arange(12))}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(7)
    check(whitening.whitened(frame), vectors)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = {1: [0.5, -0.25, 3.0], 2: [1.0, 2.0, -1.0], 3: [0.1, 0.2, 0.3], 4: [1e6, 0.0, 0.0], 5: [0.0, 0.0, 0.0]}
    rows = list(vectors.items()) + [(6, None), (7, [1.0, None, 2.0]), (8, [nan, 0.0, 0.0]), (9, [inf, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as x", "3 as place", "4 as total", "5 as n")
    # One row towers over the others, so the small components keep fewer digits.
    check(whitening.whitened(frame), vectors, close=1e-6)


def test_short_vectors_are_filled_up(spark):
    vectors = {1: [1.0, 2.0], 2: [0.0, 0.0], 3: [3.0, 0.0], None: [0.5, -4.0]}
    rows = [(1, [1.0, 2.0]), (2, []), (3, [3.0]), (None, [0.5, -4.0])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {row["id"] for row in got} == set(vectors)
    centred, n, deviation, _, _ = brute(list(vectors.values()))
    assert {row["id"]: int(row["deviation"]) for row in got} == dict(zip(vectors, deviation))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [0.5]), (1, [0.5])], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() == []


def test_equal_eigenvalues(spark):
    # A cross: four axes of exactly the same variance, so a Krylov space of one start vector ends after one step.
    rows, key = [], 0
    for axis in range(4):
        for side in (-2.0, 2.0):
            rows.append((key, [side if i == axis else 0.0 for i in range(4)]))
            key += 1
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 32 and all(row["identity_error"] < 1e-12 for row in got)
    assert all(row["explained"] == pytest.approx(0.25, rel=1e-12) for row in got)


def test_fewer_rows_than_dimensions_and_repeated_rows(spark):
    random = np.random.default_rng(2)
    base = random.normal(size=(5, 30))
    vectors = {i: list(map(float, base[i % 5])) for i in range(10)}
    check(whitening.whitened(spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")), vectors)


def test_tolerance_stops_earlier(spark, monkeypatch):
    random, passes = np.random.default_rng(3), []
    vectors = {i: list(map(float, row)) for i, row in enumerate(random.normal(size=(200, 40)) * 2.0 ** -np.arange(40))}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    summed = whitening._summed
    monkeypatch.setattr(whitening, "_summed", lambda *rest: passes.append(1) or summed(*rest))
    check(whitening.whitened(frame, wanted=3, tolerance=1e-13), vectors, wanted=3)
    assert len(passes) < 35


def test_large_counts_stay_exact():
    rows = whitening.Centre(2**40, 2, (7, -5))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([[2**40, 3]], pa.list_(pa.int64()))], ["x"])
    [(_, deviation)] = rows.deviations(batch)
    assert deviation.tolist() == [[2**80 - 7, 3 * 2**40 + 5]]


def test_registered_query(spark):
    from lakemart.llm.catalog import QUERIES

    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {row["vec_id"]: [float(c) for c in row["embedding"]] for row in table.collect()}
    found = QUERIES["op13_whitening"].build(spark, SF)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                  "whitened": "double", "explained": "double", "identity_error": "double"}
    check(found.withColumnRenamed("vec_id", "id"), vectors)
