"""Copies of large tables in Spark buckets of a join key, so that they are joined where they lie."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakemart.functions.casts import quoted
from lakemart.operators.projection import writable
from lakemart.session import scratch_path


def colocated(df: DataFrame, key: str, buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """``df`` written as a catalogue table of so many buckets of ``key``, sorted inside, and read back.

    Tables of one number of buckets join on the key without an exchange of either. Rows are dealt to their
    buckets first, so a bucket is one file; a table of that name is replaced.
    """
    spark = df.sparkSession
    table = name or f"colocated_{uuid.uuid4().hex}"
    spark.sql(f"drop table if exists {table}")
    (writable(df).repartition(buckets, quoted(key)).write.mode("overwrite").option("path", path or scratch_path(spark, "colocated"))
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def colocated_join(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows with the attributes of the dimension, unmatched ones null; the dimension has one row per key.

    Rows without a key are set aside: they match nothing, and would all be in one bucket's join.
    """
    on = F.col(quoted(key))
    attributes = [field for field in dimension.schema.fields if field.name != key]
    met = fact.where(on.isNotNull()).join(dimension.where(on.isNotNull()), key, "left").select(
        *map(quoted, fact.columns), *[quoted(field.name) for field in attributes])
    return met.unionByName(fact.where(on.isNull()).withColumns({
        field.name: F.lit(None).cast(field.dataType) for field in attributes}))
