"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x, so counts, sums and squared deviations are exact. Every step is one
pass over the written rows: a task centres its rows, forms X v for the newest right vector, takes out the
share of the previous left vector and returns three small sums, Uᵀu, u·u and Xᵀu. The driver holds
vectors of the length of one row only. The left vectors are as long as the table and are never moved: they
are linear in the rows, U R = X V with R the triangle of coefficients so far, so each task rebuilds
its own part of U from V and R. Both sides are reorthogonalised in full: the right vectors directly,
the left ones through Uᵀu, with a second pass where one correction does not reach the last digits.
R is bidiagonal but for those corrections; its singular values and vectors give deviations and components.

The steps go on until they span the rows' whole space, one step a dimension, since a single start
vector cannot tell equal eigenvalues apart earlier; a start over takes place where a step finds an
invariant subspace. ``tolerance`` stops wide vectors at converged components instead.

A task is a pure function of its rows and the driver's small coefficients, so a lost executor costs its
tasks alone.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; entries are
held within ±2**30; shorter vectors, the empty one too, are filled up with zeros to the longest; repeated rows
count and come out each; null ids are carried along; components without variance are left out, so one
row, or equal ones, gives no rows, as an empty table does; ``deviation`` is null beyond 38 digits; other columns are ignored. There are no texts here.
"""

from __future__ import annotations

import dataclasses
import decimal
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import name_of, stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Largest entry; more would not leave room for exact sums.
LARGEST = float(2**30)
#: Rows centred at once: bounds a task's memory whatever an Arrow batch holds.
STRIPE = 4096


def whole_entries(vector: Column) -> Column:
    """The entries as whole numbers; null where the vector cannot be used."""
    entries = vector.cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = F.transform(entries, lambda c: F.floor(F.least(F.greatest(c, F.lit(-LARGEST)), F.lit(LARGEST)) * SCALE) + SHIFT)
    return F.when(finite, held)


@dataclasses.dataclass(frozen=True)
class Centre:
    """Count, width and sums per dimension of the written rows."""

    n: int
    width: int
    sums: tuple[int, ...]

    def deviations(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, n x - S of a stripe of rows), whole numbers: int64 where they fit, else Python's."""
        lists = batch.column(batch.schema.get_field_index("x"))
        for at in range(0, batch.num_rows, STRIPE):
            part = lists.slice(at, STRIPE)
            if len(part) == 0:
                continue
            lengths = np.diff(part.offsets.to_numpy())
            x = np.full((len(part), self.width), SHIFT, np.int64)
            x[np.arange(self.width) < lengths[:, None]] = part.flatten().to_numpy()
            # |x| is below 2**41, and so is the mean's size.
            exact = np.int64 if self.n < 2**21 else object
            yield at, self.n * x.astype(exact) - np.array(self.sums, exact)

    def centred(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, x - S / n of a stripe of rows), each entry rounded once."""
        for at, deviation in self.deviations(batch):
            yield at, (deviation / self.n).astype(np.float64)


def prepared(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, Centre]:
    """The usable rows, written as id and x, and their centre."""
    found = vectors.select(name_of(id_column).alias("id"), whole_entries(name_of(vector_column)).alias("x"))
    table = stored(found.where(F.col("x").isNotNull()), "whole-vectors")
    n, width = table.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if not n or not width:
        return table, Centre(n, 0, ())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            # With n = 1 and no sums the deviations are the entries themselves.
            for _, x in Centre(1, width, (0,) * width).deviations(batch):
                total = total + x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(width), pa.int32()),
            pa.array([decimal.Decimal(int(one)) for one in total], pa.decimal128(38, 0))], ["place", "total"])

    added = table.select("x").mapInArrow(add, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    sums = {row["place"]: int(row["total"]) for row in added.collect()}
    return table, Centre(n, width, tuple(sums[place] for place in range(width)))


def _summed(table: DataFrame, centre: Centre, partial: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``partial(centred rows)`` over all rows, added up per task and then by Spark."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for _, part in centre.centred(batch):
                total += partial(part)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["place", "total"])

    added = table.select("x").mapInArrow(add, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    found = np.zeros(size)
    for row in added.collect():
        found[row["place"]] = row["total"]
    return found


def left_vectors(products: np.ndarray, triangle: np.ndarray) -> np.ndarray:
    """U with U R = products, column by column; the column of a vanished coefficient is zero."""
    left = np.zeros_like(products)
    for j in range(products.shape[1]):
        if triangle[j, j]:
            left[:, j] = (products[:, j] - left[:, :j] @ triangle[:j, j]) / triangle[j, j]
    return left


def _fresh(right: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A unit vector at right angles to the columns of ``right``."""
    while True:
        one = random.standard_normal(len(right))
        for _ in range(3):
            one = one - right @ (right.T @ one)
        if (size := np.linalg.norm(one)) > 1e-6:
            return one / size


def bidiagonalised(
    table: DataFrame, centre: Centre, wanted: int, tolerance: float | None,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(right vectors V, coefficients R, squared norm of the centred rows) with X V = U R."""
    width, random = centre.width, np.random.default_rng(13)
    norm = float(_summed(table, centre, lambda part: np.array([np.einsum("ij,ij->", part, part)]), 1)[0])
    right, triangle, back = np.zeros((width, 0)), np.zeros((0, 0)), np.zeros((width, 0))
    tiny = np.sqrt(norm) * np.finfo(float).eps * 8
    one, held = _fresh(right, random), 0.0
    while right.shape[1] < width and norm - held > norm * np.finfo(float).eps * 8:
        k = right.shape[1]
        right = np.column_stack([right, one])
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k] = triangle
        if k:
            # The previous left vector's share: what the last step left over behind its own.
            grown[k - 1, k] = beta
        triangle = grown
        for _ in range(3):
            def step(part: np.ndarray, v=right, r=triangle) -> np.ndarray:
                products = part @ v
                left = left_vectors(products[:, :k], r)
                u = products[:, k] - left @ r[:k, k]
                return np.concatenate([left.T @ u, [u @ u], part.T @ u])

            found = _summed(table, centre, step, k + 1 + width)
            share, square, down = found[:k], found[k], found[k + 1:]
            triangle = triangle.copy()
            triangle[:k, k] += share
            if np.linalg.norm(share) <= 1e-9 * np.sqrt(square) or square <= tiny**2:
                break
        alpha = np.sqrt(max(square - share @ share, 0.0))
        if alpha <= tiny:
            alpha, column = 0.0, np.zeros(width)
        else:
            column = (down - back @ share) / alpha
        triangle[k, k] = alpha
        back = np.column_stack([back, column])
        held += float((triangle[:, k] ** 2).sum())
        rest = column - alpha * one
        for _ in range(3):
            rest = rest - right @ (right.T @ rest)
        beta = float(np.linalg.norm(rest))
        if tolerance is not None and k + 1 > wanted:
            turned, sizes, _ = np.linalg.svd(triangle)
            if (beta * np.abs(turned[-1, :wanted + 1]) <= tolerance * sizes[0]).all():
                break
        if beta > tiny:
            one = rest / beta
        elif right.shape[1] < width:
            beta, one = 0.0, _fresh(right, random)
    return right, triangle, norm


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    wanted: int = COMPONENTS, tolerance: float | None = None,
) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    schema = (f"id {vectors.schema[id_column].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
              "whitened double, explained double, identity_error double")
    table, centre = prepared(vectors, id_column, vector_column)
    if not centre.width:
        return vectors.sparkSession.createDataFrame([], schema)
    right, triangle, norm = bidiagonalised(table, centre, wanted, tolerance)
    if not right.shape[1]:
        return vectors.sparkSession.createDataFrame([], schema)
    _, sizes, turned = np.linalg.svd(triangle)
    count = min(wanted, int((sizes > sizes[0] * np.finfo(float).eps * centre.width).sum()))
    sizes, axes = sizes[:count], right @ turned[:count].T
    axes /= np.linalg.norm(axes, axis=0)
    scale = axes * (np.sqrt(centre.n) / sizes)

    def spread(part: np.ndarray) -> np.ndarray:
        out = part @ scale
        return np.concatenate([out.sum(axis=0), (out.T @ out).ravel()])

    sums = _summed(table, centre, spread, count + count**2) / centre.n
    covariance = sums[count:].reshape(count, count) - np.outer(sums[:count], sums[:count])
    identity_error = float(np.abs(covariance - np.eye(count)).max())
    explained = sizes**2 / norm

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("id"))
            for at, deviation in centre.deviations(batch):
                m = len(deviation)
                fits = deviation.dtype != object and np.abs(deviation).max() < 2**31 / np.sqrt(centre.width)
                squares = (deviation if fits else deviation.astype(object)) ** 2
                exact = [decimal.Decimal(int(one)) if one < 10**38 else None for one in squares.sum(axis=1)]
                out = (deviation / centre.n).astype(np.float64) @ scale
                each = np.repeat(np.arange(m), count)
                yield pa.RecordBatch.from_arrays([
                    names.slice(at, m).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()),
                    pa.array(np.full(m * count, centre.n)), pa.array(exact, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(out.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * count, identity_error)),
                ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(project, schema)
