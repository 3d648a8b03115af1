"""Every registered query against its SQL on DuckDB, on the smallest driver tables."""

import pathlib
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakemart.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(SF).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def multiset(table):
    names = sorted(table.column_names)
    return names, Counter(zip(*[table.column(name).to_pylist() for name in names]))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    got = multiset(queries()[name](spark, SF).toArrow())
    assert got == multiset(duck.sql(oracle_sql()[name]).to_arrow_table())


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(oracle_sql()) and set(REGISTRY) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["data", "user_id", "event_id", "event_type", "value"]
