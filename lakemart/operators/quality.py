"""Row filters, gates and audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation, functions as F

from lakemart.functions.casts import quoted


class GateError(ValueError):
    """A load was refused before anything was written."""


def all_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.where(reduce(and_, [F.col(quoted(name)).isNotNull() for name in columns]))


def split_rejects(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every listed column, rows lacking one of them)."""
    lacking = reduce(or_, [F.col(quoted(name)).isNull() for name in columns])
    return df.where(~lacking), df.where(lacking)


def exclude_ids(df: DataFrame, column: str, ids: Iterable | DataFrame) -> DataFrame:
    """Rows whose id is not listed; a null id is dropped as in ``NOT IN``.

    A short list is a filter; a frame of ids becomes an anti join.
    """
    if isinstance(ids, DataFrame):
        listed = ids.select(F.col(quoted(ids.columns[0])).alias(column))
        return df.where(F.col(quoted(column)).isNotNull()).join(listed, [column], "left_anti")
    return df.where(~F.col(quoted(column)).isin(list(ids)))


def any_positive(df: DataFrame, amounts: Sequence[str], counts: Sequence[str] = ()) -> DataFrame:
    """Rows with an amount above 0 or a count of at least 1; null and NaN count as 0."""
    def number(name):
        return F.coalesce(F.nanvl(F.col(quoted(name)).try_cast("double"), F.lit(0.0)), F.lit(0.0))

    tests = [number(name) > 0 for name in amounts] + [number(name) >= 1 for name in counts]
    return df.where(reduce(or_, tests))


def missing_key_report(df: DataFrame, day: str, key: str) -> DataFrame:
    """Days holding records without their id, with the number of such records."""
    return (
        df.groupBy(F.col(quoted(day)).alias(day))
        .agg(F.count_if(F.col(quoted(key)).isNull()).alias("missing"))
        .where("missing > 0")
    )


def require_keys(df: DataFrame, day: str, key: str) -> None:
    """Refuse the load when any record lacks its id; the message names the five worst days."""
    worst = missing_key_report(df, day, key).orderBy(F.desc("missing"), day).limit(5).collect()
    if worst:
        days = ", ".join(f"{row[day]} ({row['missing']})" for row in worst)
        raise GateError(f"records without {key}: {days}")


def counted_keys(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """(``df``, what its next write counts on the way: ``records`` and those ``missing`` their key)."""
    counts = Observation()
    counted = df.observe(counts, F.count(F.lit(1)).alias("records"), F.count_if(F.col(quoted(key)).isNull()).alias("missing"))
    return counted, counts


def snapshot_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: is it there, and how many rows and values does it have."""
    stats = [F.count(F.lit(1)).alias("_rows")]
    stats += [
        (F.count(quoted(name)) if name in df.columns else F.lit(0).cast("bigint")).alias(f"_{position}")
        for position, name in enumerate(required)
    ]
    checks = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.lit(name in df.columns).alias("present"),
            F.col("_rows").alias("row_count"), F.col(f"_{position}").alias("value_count"),
        )
        for position, name in enumerate(required)
    ])
    return df.agg(*stats).select(F.inline(checks))


def require_snapshot(df: DataFrame, required: Sequence[str]) -> None:
    """Refuse a snapshot without rows or without its required columns."""
    lacking = [name for name in required if name not in df.columns]
    if lacking:
        raise GateError(f"snapshot lacks columns {lacking}")
    if df.isEmpty():
        raise GateError("snapshot has no rows")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return (
        df.groupBy(*[F.col(quoted(name)) for name in keys])
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Refuse rows that share a key; null keys match nothing and so clash with nothing."""
    clash = duplicate_keys(all_present(df, keys), keys).limit(1).collect()
    if clash:
        shown = {name: clash[0][name] for name in keys}
        raise GateError(f"several rows of key {shown}")


def coverage(df: DataFrame, key: str, column: str) -> DataFrame:
    """How many distinct keys have a non-empty value, of how many."""
    found = df.groupBy(F.col(quoted(key))).agg(F.max(F.coalesce(F.col(quoted(column)) != "", F.lit(False))).alias("found"))
    return found.agg(F.count_if("found").alias("resolved"), F.count(F.lit(1)).alias("total"))
