"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so a node with a third of all links is one row per task in
the one and a splittable join key in the other. Every round is written to the shared scratch folder:
lineage stays short and a lost executor costs a reread. The rounds grow with the logarithm of the
longest path; links that already form stars around their smallest nodes need none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """a, b (links between long ids) -> node, root, the smallest node it can reach.

    Only nodes that have a link to another one appear. The order of a and b, repeated links and loops
    do not matter; null ends are left out.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour moves to the least of the neighbourhood.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node's own edge to the least must stay where it has no larger neighbour's help.
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: every smaller neighbour moves to the least of them.
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or none and only edges from above."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0").isEmpty()
