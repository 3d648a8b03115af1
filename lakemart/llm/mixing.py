"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is an exponential variate divided by its quality weight; in key order a prefix of a
source is a weighted sample without replacement. The variate comes from a digest of the id, so reruns
agree. A source's target is ``budget`` times all words, shared by weight, at most ``most_epochs`` times
the source, the excess reshared by weight. Complete epochs of the source come first; what is left of
the target is filled by the key-ordered prefix whose words end nearest to it. Documents are never cut.

A source is not sorted as a whole. Keys fall into ``CELLS`` cells; the words per source and cell tell
which cells lie wholly inside the remaining target, and only the one cell where it ends is sorted. A
source with a third of all documents so brings one 4096th of them to one task.

Defined results: a null text has no words; a null source is a source, the last one; a null id is
sampled like the empty id; rows that repeat an id have the same key and are drawn one after the other;
documents without words follow their place in the order; an empty table gives no rows; other columns
are ignored by ``mixed`` and carried along by ``apply_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import BLANKS, free_name, name_of, stored, text_of

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_EPOCHS = 2
CELLS = 4096
#: Quality weight of a document nobody labelled.
UNLABELLED = 1.5


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(BLANKS.replace("[", "[^"))).cast("long")


def label_weights(labels: DataFrame, id_column: str = "doc_id", quality: str = "quality") -> DataFrame:
    """id, weight: one plus the mean quality label of each document."""
    known = labels.select(name_of(id_column).alias("id"), name_of(quality).alias("quality")).dropna()
    return known.groupBy("id").agg((1 + F.avg("quality")).alias("weight"))


def exponential_key(identifier: Column, weight: Column) -> Column:
    """An exponential variate of rate ``weight`` from 52 bits of the id's digest."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(identifier.cast("string"), F.lit(""))).cast("binary")), 1, 13), 16, 10)
    return -F.log((bits.cast("long") + 1) / F.lit(float(2**52))) / weight


def sums_before(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """``rows`` with the sums over all rows before each one in a total order, by ranges: no task holds more than one.

    Only the totals of the ranges, a row per partition, are summed in one task.
    """
    placed = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), label)
    earlier = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("range").agg(*[F.sum(one).alias(name) for name, one in sums.items()]).select(
        "range", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_offset") for name in sums])
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumns({name: F.coalesce(F.sum(one).over(inside), F.lit(0)) for name, one in sums.items()}).join(
        offsets, "range").select(*rows.columns, *[(F.col(name) + F.col(f"{name}_offset")).alias(name) for name in sums])


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, most_epochs: int) -> DataFrame:
    """source, source_size -> with target.

    Sources in the order of size per weight: those at the front reach their limit first, and the rest
    share what those leave. There may be as many sources as documents.
    """
    by_name = [F.col("source").isNull(), F.col("source")]
    weighted = sums_before(sizes, by_name, {"place": F.lit(1)}, "mix-sources").select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most_epochs).alias("limit"))
    words, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    total = F.lit(float(words or 0) * budget)
    left = sums_before(weighted, [F.col("limit") / F.col("weight"), *by_name], {"limits": F.col("limit"), "passed": F.col("weight")}, "mix-limits")
    full = stored(left.withColumn(
        "full", (total - F.col("limits")) * F.col("weight") >= F.col("limit") * (F.lit(weight or 0) - F.col("passed"))), "mix-targets")
    limits, open_weight = full.agg(
        F.sum(F.when(F.col("full"), F.col("limit"))), F.sum(F.when(~F.col("full"), F.col("weight")))).first()
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        F.col("weight") * (total - F.lit(limits or 0)) / F.lit(open_weight or 1))
    return full.select("source", "source_size", target.alias("target"))


def mixed(
    docs: DataFrame, quality_weights: DataFrame | None = None, id_column: str = "doc_id", source_column: str = "source",
    text_column: str = "text", weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, most_epochs: int = MOST_EPOCHS,
    cells: int = CELLS,
) -> DataFrame:
    """Per row: id, size, source, source_size, target, copies (how often the mix takes the document)."""
    sized = docs.select(
        name_of(id_column).alias("id"), name_of(source_column).cast("string").alias("source"),
        word_count(text_of(text_column)).alias("size"),
    )
    if quality_weights is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        sized = sized.join(quality_weights.select("id", "weight"), "id", "left").withColumn(
            "weight", F.coalesce("weight", F.lit(UNLABELLED)))
    keyed = sized.withColumn("key", exponential_key(F.col("id"), F.col("weight"))).withColumn(
        "cell", F.floor((1 - F.exp(-F.col("key"))) * cells).cast("int"))
    rows = stored(keyed.select("id", "source", "size", "key", "cell"), "mix-rows")
    by_cell = stored(rows.groupBy("source", "cell").agg(F.sum("size").alias("words")), "mix-cells")
    goal = targets(by_cell.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, most_epochs)
    goal = goal.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("int")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    reached = by_cell.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    edges = goal.alias("g").join(reached.alias("c"), F.expr(
        "g.source <=> c.source and c.before <= g.rest and g.rest < c.before + c.words"), "left").select(
            "g.*", F.col("c.cell").alias("edge"), F.col("c.before").alias("before"))
    edges = stored(edges, "mix-edges")
    placed = rows.alias("r").join(edges.alias("e"), F.expr("r.source <=> e.source")).select(
        "r.*", "e.source_size", "e.target", "e.epochs", "e.rest", "e.edge", "e.before")

    # Where the epochs reach the target no document comes once more, one without words neither.
    more = F.col("rest") > 0
    outside = placed.where("cell != edge or edge is null").withColumn(
        "copies", F.col("epochs") + F.coalesce(((F.col("cell") < F.col("edge")) & more).cast("int"), F.lit(0)))
    in_order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.where("cell = edge").withColumn(
        "middle", F.col("before") + F.sum("size").over(in_order) - F.col("size") / 2).withColumn(
        "copies", F.col("epochs") + ((F.col("middle") <= F.col("rest")) & more).cast("int")).drop("middle")
    return outside.unionByName(inside).select("id", "size", "source", "source_size", "target", "copies")


def apply_mix(docs: DataFrame, decisions: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Rows that repeat an id share one decision."""
    names = docs.columns
    theirs, times, each = (free_name(name, names) for name in ("mixed_id", "copies", "copy"))
    per_id = decisions.groupBy(F.col("id").alias(theirs)).agg(F.max("copies").alias(times)).where(F.col(times) > 0)
    taken = docs.join(per_id, name_of(id_column).eqNullSafe(F.col(theirs)))
    return taken.withColumn(each, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*map(name_of, names))
