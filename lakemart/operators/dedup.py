"""Deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions.casts import quoted
from lakemart.operators.projection import select_present

#: Up to this share of rows with a repeated grain they are taken out of the others.
MOST_REPEATED = 0.1


def keep_last(df: DataFrame, grain: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per grain: the one with the greatest ``order_by``, nulls lowest.

    An aggregate rather than a ranking window, so every task reduces its rows to one per key
    before the shuffle and a hot key never gathers in one task. It sorts by the hash of the grain first: text
    and days that begin alike would have every comparison read the whole keys.
    """
    ordering = [F.col(quoted(item)) if isinstance(item, str) else item for item in order_by]
    if not ordering:
        raise ValueError("keep_last needs an explicit order")
    rest = [name for name in df.columns if name not in grain]
    keys = [F.col(quoted(name)) for name in grain]
    if not rest:
        return df.select(*keys).distinct()
    winner = F.max_by(F.struct(*[F.col(quoted(name)) for name in rest]), F.struct(*ordering))
    last = df.groupBy(F.xxhash64(*keys).alias("_grain"), *keys).agg(winner.alias("_last"))
    return last.select(*[
        F.col(quoted(name)) if name in grain else F.col("_last").getField(name).alias(name)
        for name in df.columns
    ])


def keep_last_of_scan(df: DataFrame, grain: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """``keep_last`` of a plain scan of which most rows are expected to have a grain of their own.

    A first pass reads the grain alone and counts its hashes. Rows whose hash comes once are the last of their grain
    and are neither sorted nor moved; ``keep_last`` decides among the others. Where these are many, it takes all rows as they are.
    """
    hashed = F.xxhash64(*[F.col(quoted(name)) for name in grain])
    counts = df.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = counts.where("_rows > 1")
    total, among = counts.agg(F.sum("_rows"), F.sum(F.when(F.col("_rows") > 1, F.col("_rows")))).first()
    if not among:
        return df
    if among > MOST_REPEATED * total:
        return keep_last(df, grain, order_by)
    marked = df.withColumn("_hash", hashed)
    alone = marked.join(repeated, "_hash", "left_anti").drop("_hash")
    others = marked.join(repeated, "_hash", "left_semi").drop("_hash")
    return alone.unionByName(keep_last(others, grain, order_by))


def distinct_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct combinations of the listed columns that exist."""
    return select_present(df, columns).distinct()
