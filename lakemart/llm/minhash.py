"""Near duplicates by b-bit MinHash.

A document is the set of its word shingles; two documents are linked where the Jaccard similarity of
their sets reaches ``percent``. Of every minimum the low eight bits are retained and packed into words;
equal lanes are counted with bit operations and corrected for lanes that agree by chance.

1. Documents of equal sets form a class, and one member stands for it from here on.
2. Bands of full minima put classes into buckets. With 32 bands of four rows a pair at similarity 0.8 is
   missed with probability 5e-8.
3. Links are found in rounds. A round pairs the members of a bucket with one hub, drops pairs whose
   estimate lies more than ``MARGIN`` standard deviations below the limit, and confirms the others on
   the full sets. Members that are connected already are not compared again, so a group of near copies
   costs about one comparison per member, not per pair.
4. Buckets that then still hold several components are searched exhaustively, without a limit on their
   number. In small ones every pair of different components is confirmed like before. In large ones a
   task first marks, by estimates alone, the members that may have a link across components; these are
   gathered with their full sets around the bucket's largest component, and those outside of it are
   compared with all others, in pairs of blocks, so that no task holds more than two. Such a task returns links between components, never all pairs.

So no pair of different components with enough similarity stays unseen, and the components are those of
all links. Sets are moved only for classes that share a bucket.

Defined results: a null text is the empty text; of a very long text all shingles count, permuted in slices; a text without words has an empty set, is linked with
nothing and is kept; a text of fewer words than the shingle's width is one shingle; null ids count as
larger than every id (a component of null ids alone has the id null); of repeated rows one is kept; an
empty table gives no rows; other columns are ignored by ``near_duplicates`` and carried by ``keep_first``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import apply_verdicts, name_of, split_by_bucket, stored, text_of
from lakemart.llm.components import components
from lakemart.llm.shingles import band_keys, minima, shingle_set

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 32, 4
LANES = BANDS * ROWS
MARGIN = 4.5
#: Rounds with a hub before the exhaustive search; they only save work.
HUB_ROUNDS = 2
#: Members of a bucket whose pairs are written out in the exhaustive search.
SMALL_BUCKET = 16
#: Rows of a block of a large group, and hashes of their sets; a task compares two blocks.
BLOCK = 512
BLOCK_SIZE = 2**21
LANE_LOW = 0x0101010101010101


def estimate(equal_lanes):
    """Similarity from the share of equal eight-bit lanes, without those that agree by chance."""
    return (equal_lanes / LANES - 2**-8) / (1 - 2**-8)


def least_lanes(percent: int) -> int:
    """Equal lanes that a pair at the limit has, but for ``MARGIN`` standard deviations."""
    agree = percent / 100 * (1 - 2**-8) + 2**-8
    return math.floor(LANES * (agree - MARGIN * math.sqrt(agree * (1 - agree) / LANES)))


def _lists(matrix: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32), pa.array(matrix.ravel()))


def signatures(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """row, id, text_hash, n, class (digest of the set), keys (one per band), low (packed low bits)."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), name_of(id_column).alias("id"),
        F.xxhash64(text_of(text_column)).alias("text_hash"), text_of(text_column).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, minimal = [], [], []
            for text in batch.column(3):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                classes.append(xxhash.xxh3_128_digest(shingles))
                minimal.append(minima(shingles, LANES) if len(shingles) else np.zeros(LANES, np.uint32))
            least = np.array(minimal, np.uint32).reshape(-1, LANES)
            low = np.ascontiguousarray(least.astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 _lists(band_keys(least, BANDS)), _lists(low)],
                ["row", "id", "text_hash", "n", "class", "keys", "low"])

    kind = texts.schema["id"].dataType.simpleString()
    return stored(texts.mapInArrow(
        sign, f"row long, id {kind}, text_hash long, n long, class binary, keys array<long>, low array<long>"), "signatures")


def _equal_lanes(one: Column, other: Column) -> Column:
    """Equal bytes of two packed signatures: a differing byte folds to one bit."""
    def differing(x: Column, y: Column) -> Column:
        folded = x.bitwiseXOR(y)
        for shift in (4, 2, 1):
            folded = folded.bitwiseOR(F.shiftrightunsigned(folded, shift))
        return F.bit_count(folded.bitwiseAND(F.lit(LANE_LOW))).cast("int")

    return F.lit(LANES) - F.aggregate(F.zip_with(one, other, differing), F.lit(0), lambda total, n: total + n)


def _sets(docs: DataFrame, nodes: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """node, shingles: the full sets of the classes' first members, from their texts."""
    texts = docs.select(name_of(id_column).alias("id"), F.xxhash64(text_of(text_column)).alias("text_hash"),
                        text_of(text_column).alias("text"))
    # Texts of other documents are dropped before the shuffle.
    some, _ = split_by_bucket(texts, F.struct("id", "text_hash"), nodes, F.struct("id", "text_hash"))
    wanted = nodes.select(F.col("id").alias("node_id"), F.col("text_hash").alias("node_hash"), "node", "class")
    found = some.join(wanted, F.col("id").eqNullSafe(F.col("node_id")) & (F.col("text_hash") == F.col("node_hash")))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(text.as_py(), width) for text in part.column(2)]
                own = [xxhash.xxh3_128_digest(found) == known.as_py() for found, known in zip(sets, part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own), pa.array([found.view(np.int64) for found in sets], pa.list_(pa.int64()))],
                    ["node", "own", "shingles"])

    sets = found.select("node", "class", "text").mapInArrow(whole, "node long, own boolean, shingles array<long>")
    # Rows that repeat id and text give the same set again.
    return stored(sets.where("own").drop("own").dropDuplicates(["node"]), "shingle-sets")


def _linked(pairs: DataFrame, lows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, after their estimates were."""
    sided = (pairs.join(lows.select(F.col("node").alias("a"), F.col("low").alias("low_a")), "a")
             .join(lows.select(F.col("node").alias("b"), F.col("low").alias("low_b")), "b"))
    pairs = sided.where(_equal_lanes(F.col("low_a"), F.col("low_b")) >= least_lanes(percent)).select("a", "b")
    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - F.col("both")
    return stored(full.withColumn("both", both).where(F.col("both") * 100 >= either * percent).select("a", "b"), "near-links")


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node, component of the buckets that hold several components."""
    labelled = members.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("component"))
    several = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")
    return stored(labelled.join(several, "key"), "open-buckets")


def _pairs_of(small: DataFrame) -> DataFrame:
    """a, b: the pairs of different components in buckets of at most ``SMALL_BUCKET`` members."""
    one, other = (small.select("key", F.col("node").alias(end), F.col("component").alias(f"{end}_in")) for end in "ab")
    return one.join(other, "key").where("a > b and a_in != b_in").select("a", "b").distinct()


def _blocked(rows: DataFrame, group: str, outside: Column) -> DataFrame:
    """One row per row and pair of blocks (x, y) of the group that it takes part in.

    ``rows`` have ``size``, the numbers that a row brings along. The rows outside and the others are in blocks
    of their own, those outside in the first ones. A block of rows outside meets every block, itself included.
    """
    sided = rows.withColumn("outer", outside)
    blocks = lambda wanted: F.greatest(
        F.ceil(F.count(F.when(wanted, 1)) / BLOCK), F.ceil(F.coalesce(F.sum(F.when(wanted, F.col("size"))), F.lit(0)) / BLOCK_SIZE)).cast("int")
    counted = sided.groupBy(group).agg(blocks(F.col("outer")).alias("outers"), blocks(~F.col("outer")).alias("inners"))
    sized = sided.join(counted, group)
    dealt = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    own = sized.withColumn("block", F.when(F.col("outer"), dealt("outers")).otherwise(F.col("outers") + dealt("inners")))
    last = F.when(F.col("outer"), F.col("outers") + F.col("inners")).otherwise(F.col("outers")) - 1
    # Where no row is outside there is nothing to compare.
    met = own.where("outers > 0").withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return met.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")).drop(
        "outer", "outers", "inners", "other", "size")


def _sides(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Of a pair of blocks each row of the one with the rows of the other, no pair twice."""
    block, x, y = rows["block"].to_numpy(), rows["x"].iloc[0], rows["y"].iloc[0]
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    for at, i in enumerate(left):
        yield i, right[at + 1:] if x == y else right


def _near(low: np.ndarray, one: np.ndarray, floor: int) -> np.ndarray:
    """Which rows of packed signatures have enough lanes in common with one signature."""
    folded = low ^ one
    for shift in (4, 2, 1):
        folded |= folded >> np.uint64(shift)
    return np.bitwise_count(folded & np.uint64(LANE_LOW)).sum(axis=1) <= LANES - floor


def _marked(large: DataFrame, lows: DataFrame, percent: int) -> DataFrame:
    """group (a component), node: members of large buckets that may have a link across components."""
    counted = large.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("group"))
    rows = large.join(largest, "key").join(lows, "node").withColumn("size", F.lit(LANES // 8))
    blocks = _blocked(rows, "key", F.col("component") != F.col("group"))
    floor = least_lanes(percent)

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        low = np.vstack(rows["low"].to_numpy()).view(np.uint64)
        node, component, marked = rows["node"].to_numpy(), rows["component"].to_numpy(), np.zeros(len(rows), bool)
        for i, others in _sides(rows):
            near = others[_near(low[others], low[i], floor) & (component[others] != component[i])]
            marked[near], marked[i] = True, marked[i] or len(near) > 0
        return pd.DataFrame({"group": rows["group"].iloc[0], "node": node[marked]})

    return blocks.select("key", "x", "y", "block", "group", "node", "component", "low").groupBy("key", "x", "y").applyInPandas(
        mark, "group long, node long").distinct()


def _searched(marked: DataFrame, labels: DataFrame, lows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links that join the components of the marked members of each group."""
    rows = marked.join(labels, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
    rows = rows.join(sets.select("node", F.size("shingles").alias("size")), "node")
    blocks = _blocked(rows, "group", F.col("component") != F.col("group"))
    floor = least_lanes(percent)

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        low, sets = np.vstack(rows["low"].to_numpy()).view(np.uint64), rows["shingles"].to_numpy()
        node, tree, found = rows["node"].to_numpy(), rows["component"].to_numpy().copy(), []
        for i, others in _sides(rows):
            near = others[_near(low[others], low[i], floor) & (tree[others] != tree[i])]
            if not len(near):
                continue
            sizes = np.array([len(sets[j]) for j in near])
            shared = np.isin(np.concatenate([sets[j] for j in near]), sets[i])
            both = np.add.reduceat(shared, np.cumsum(sizes) - sizes, dtype=np.int64)
            linked = near[both * 100 >= (sizes + len(sets[i]) - both) * percent]
            # One link to each component is enough, and from here on they are one.
            for other, at in zip(*np.unique(tree[linked], return_index=True)):
                found.append((node[i], node[linked[at]]))
                tree[tree == other] = tree[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    full = blocks.join(lows.select("node", "low"), "node").join(sets.select("node", "shingles"), "node")
    return full.select("group", "x", "y", "block", "node", "component", "low", "shingles").groupBy("group", "x", "y").applyInPandas(
        search, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT,
    hub_rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """Per row: id, text_hash, n_shingles, component_id, kept."""
    signed = signatures(docs, id_column, text_column, width)
    first = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "row", "text_hash")).alias("first")
    classes = stored(signed.where("n > 0").groupBy("class").agg(
        first, F.first("keys").alias("keys"), F.first("low").alias("low")).select(
            "class", F.col("first.row").alias("node"), F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"),
            "keys", "low"), "classes")
    each = classes.select("node", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = stored(each.join(shared, "key").select("key", "node"), "buckets")
    nodes = members.select("node").distinct()
    lows = stored(classes.join(nodes, "node").select("node", "low", "class", "id", "text_hash"), "candidates")
    sets = _sets(docs, lows, id_column, text_column, width)
    lows = lows.select("node", "low")

    labels = docs.sparkSession.createDataFrame([], "node long, root long")
    for number in range(hub_rounds + 1):
        todo = _open_buckets(members, labels)
        if todo.isEmpty():
            break
        if number < hub_rounds:
            order = F.col("node") if number == 0 else F.xxhash64("node", F.lit(number))
            hubs = todo.groupBy("key").agg(F.min(F.struct(order.alias("rank"), "node", "component")).alias("hub"))
            pairs = todo.join(hubs, "key").where("component != hub.component").select(
                F.greatest("node", "hub.node").alias("a"), F.least("node", "hub.node").alias("b")).distinct()
            links = _linked(pairs, lows, sets, percent)
        else:
            sizes = stored(todo.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
            small = _linked(_pairs_of(todo.join(sizes.where(F.col("n") <= SMALL_BUCKET), "key")), lows, sets, percent)
            large = todo.join(sizes.where(F.col("n") > SMALL_BUCKET).select("key"), "key")
            marked = stored(_marked(large, lows, percent), "marked")
            links = small.unionByName(_searched(marked, labels, lows, sets, percent))
        labels = _relabelled(labels, links)

    placed = signed.join(classes.select("class", "node"), "class", "left").join(labels, "node", "left").select(
        "row", "id", "text_hash", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).otherwise(F.col("row")).alias("component"))
    placed = stored(placed, "near-rows")
    # Written before the join: a join of two plain tables can split the rows of a hot component.
    heads = stored(placed.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "row")).alias("head")), "near-heads")
    return placed.join(heads, "component").select(
        "id", "text_hash", F.col("n").alias("n_shingles"), F.col("head.id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: the components are joined as they stand, not found from the start."""
    of = lambda end: labels.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    joined = components(between).withColumnsRenamed({"node": "old", "root": "new"})
    moved = labels.join(joined, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    fresh = joined.select(F.col("old").alias("node"), F.col("new").alias("root"))
    return stored(moved.unionByName(fresh.join(labels, "node", "left_anti")), "labels")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component."""
    verdicts = near_duplicates(docs, id_column, text_column, width, percent).select("id", F.col("text_hash").alias("mark"), "kept")
    return apply_verdicts(docs, verdicts, id_column, F.xxhash64(text_of(text_column)), once=True)
