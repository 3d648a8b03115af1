"""Near duplicates among vectors by a pivot-permutation index.

A vector is described by its ``PREFIX`` nearest reference points, the pivots, nearest first. Inverted
lists hold, per label and pivot, the vectors that name it. Two vectors of a list are candidates where
they share at least ``SHARED`` pivots; candidates are verified by their cosine in double precision, each
pair in the list of its first shared pivot. So links are exact, and what the index can miss is a pair
that shares fewer pivots (the recall is measured in the tests).

The pivots are a sample of the vectors, about twice the root of their number and ``MOST_PIVOTS`` at most,
without those within twice the link angle of another one; all vectors are indexed. So a dense group, however
large, holds few pivots: were they many, its members would name them in the order of their own noise, and
linked ones would share too few. Its lists are long instead. Equal vectors are one entry with a weight. A list longer than ``BLOCK`` is worked off in pairs of blocks, so no task holds
a whole long list, and a task returns sums and a spanning forest instead of pairs.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows
without a label, link with nothing; vectors of different lengths do not link; repeated rows are rows of
their own and link with each other; null ids count as larger than every id; of rows that repeat the
smallest id of a component one is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import name_of, stored
from lakemart.llm.components import components

LEAST_COSINE = 0.93
PREFIX = 16
SHARED = 2
FEWEST_PIVOTS, MOST_PIVOTS = 16, 4096
BLOCK = 2048
#: Rows of a block compared at once.
STRIPE = 256


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link with another one."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def pivot_count(vectors: int) -> int:
    return min(MOST_PIVOTS, max(FEWEST_PIVOTS, math.ceil(2 * math.sqrt(vectors))))


def _unit(rows: list[np.ndarray]) -> np.ndarray:
    """Unit rows; scaled by the largest component first, so that no square overflows or vanishes."""
    matrix = np.vstack(rows).astype(np.float64)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def spaced(units: np.ndarray, least_cosine: float) -> np.ndarray:
    """The rows that lie farther than twice the link angle from every row retained before them."""
    limit = math.cos(min(math.pi, 2 * math.acos(max(-1.0, min(1.0, least_cosine)))))
    apart, count = np.empty_like(units), 0
    for one in units:
        if not (apart[:count] @ one >= limit).any():
            apart[count] = one
            count += 1
    return apart[:count].copy()


def nearest(units: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of each row's ``prefix`` nearest pivots, nearest first."""
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :prefix]


def indexed(vectors: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """node, label, weight, vector -> node, label, weight, dim, unit (bytes), near (pivots, nearest first)."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, near = [], []
            lists = batch.column(batch.schema.get_field_index("vector"))
            for at in range(0, batch.num_rows, STRIPE):
                raw = [np.asarray(one.as_py(), np.float64) for one in lists.slice(at, STRIPE)]
                own = [_unit([one])[0] for one in raw]
                # A vector of another length than the pivots is cut or filled up for the description alone.
                fitted = np.zeros((len(own), pivots.shape[1]))
                for row, one in zip(fitted, own):
                    row[:min(len(one), len(row))] = one[:len(row)]
                units += [one.tobytes() for one in own]
                near += nearest(fitted, pivots, prefix).astype(np.int32).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(name)) for name in ("node", "label", "weight")]
                + [pa.array([len(unit) // 8 for unit in units], pa.int32()), pa.array(units, pa.binary()),
                   pa.array(near, pa.list_(pa.int32()))],
                ["node", "label", "weight", "dim", "unit", "near"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("node", "label", "weight", "vector").mapInArrow(
        describe, f"node long, label {kind}, weight long, dim int, unit binary, near array<int>")


def _listed(entries: DataFrame) -> DataFrame:
    """Inverted lists: one row per entry, pivot and pair of blocks (x, y) that the entry takes part in."""
    lists = entries.withColumn("pivot", F.explode("near"))
    long = lists.groupBy("label", "dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    sized = lists.join(long, ["label", "dim", "pivot"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("label", "dim", "pivot", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                        "block", "node", "weight", "unit", "near")


def _verify(rows: pd.DataFrame, shared: int, least_cosine: float) -> pd.DataFrame:
    """node, other, links: weight of the links found here, and a node of the same tree of links."""
    rows = rows.sort_values("node", ignore_index=True)
    node, weight, block = (rows[name].to_numpy() for name in ("node", "weight", "block"))
    pivot, x, y = (int(rows[name].iloc[0]) for name in ("pivot", "x", "y"))
    unit = np.vstack([np.frombuffer(one) for one in rows["unit"]])
    names, near = np.unique(np.vstack(rows["near"].to_numpy()), return_inverse=True)
    named = np.zeros((len(rows), len(names)), np.float32)
    np.put_along_axis(named, near.reshape(len(rows), -1), 1, axis=1)
    earlier = np.ascontiguousarray(named[:, names < pivot])
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    links, tree = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for at in range(0, len(left), STRIPE):
        part = left[at:at + STRIPE]
        hit = ((named[part] @ named[right].T >= shared) & (earlier[part] @ earlier[right].T == 0)
               & (unit[part] @ unit[right].T >= least_cosine))
        if x == y:
            hit &= part[:, None] < right[None, :]
        links[part] += hit @ weight[right]
        links[right] += hit.T @ weight[part]
        for i in np.flatnonzero(hit.any(axis=1)):
            joined = np.unique(np.append(tree[right[hit[i]]], tree[part[i]]))
            if len(joined) > 1:
                tree[np.isin(tree, joined)] = joined[0]
    found = links > 0
    return pd.DataFrame({"node": node[found], "other": node[tree[found]], "links": links[found]})


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    least_cosine: float = LEAST_COSINE, prefix: int = PREFIX, shared: int = SHARED,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    rows = stored(vectors.select(
        F.monotonically_increasing_id().alias("row"), name_of(id_column).alias("id"), name_of(label_column).alias("label"),
        name_of(vector_column).cast("array<double>").alias("vector")), "vectors")
    good = usable(F.col("vector"), F.col("label"))
    classes = stored(rows.where(good).groupBy("label", "vector").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"), F.count(F.lit(1)).alias("weight")).select(
            "label", "vector", F.col("first.row").alias("node"), "weight"), "vector-classes")
    count = classes.count()
    if count:
        sample = classes.orderBy(F.xxhash64("node"), "node").limit(pivot_count(count)).select("vector").collect()
        units = [_unit([np.array(one["vector"])])[0] for one in sample]
        pivots = np.zeros((len(units), max(map(len, units))))
        for row, one in zip(pivots, units):
            row[:len(one)] = one
        pivots = spaced(pivots, least_cosine)
        entries = stored(indexed(classes, pivots, prefix), "pivot-entries")
        # An index of fewer pivots than have to be shared cannot ask for more than all of them.
        enough = min(shared, len(pivots))
        found = stored(_listed(entries).groupBy("label", "dim", "pivot", "x", "y").applyInPandas(
            lambda part: _verify(part, enough, least_cosine), "node long, other long, links long"), "vector-links")
    else:
        found = vectors.sparkSession.createDataFrame([], "node long, other long, links long")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))

    known = classes.join(totals, "node", "left").join(roots, "node", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component"))
    grouped = rows.where(good).join(known, ["label", "vector"]).select("row", "id", "n_links", "component")
    alone = rows.where(~good).select("row", "id", F.lit(0).cast("long").alias("n_links"), F.col("row").alias("component"))
    placed = stored(grouped.unionByName(alone), "vector-rows")
    # Written before the join: a join of two plain tables can split the rows of a hot component.
    heads = stored(placed.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("head")), "vector-heads")
    return placed.join(heads, "component").select(
        "id", "n_links", F.col("head.id").alias("component_id"), (F.col("row") == F.col("head.row")).alias("kept"))
