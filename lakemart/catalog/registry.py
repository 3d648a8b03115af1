"""Name -> (Spark query, SQL equivalent or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """The driver's tables, and a scratch folder for queries whose feature is writing files."""

    spark: SparkSession
    folder: str

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{table}.parquet")


class Entry(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None):
    def register(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        REGISTRY[build.__name__] = Entry(lambda spark, folder: build(Source(spark, folder)), sql)
        return build

    return register
