"""Projections, defaults and write-time type clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from lakemart.functions.casts import epoch_ms_date, quoted, wall_clock_utc


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[F.col(quoted(name)) for name in columns if name in df.columns])


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.drop(*[name for name in df.columns if name.endswith(suffix)])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Null or absent columns get their default.

    A column with a fixed schema cannot tell an absent key from an explicit null; both are filled.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    return df.withColumns({
        name: F.coalesce(F.col(quoted(name)), F.lit(value).cast(types[name])) if name in types else F.lit(value)
        for name, value in defaults.items()
    })


def epoch_columns_to_dates(df: DataFrame, dates: Mapping[str, str], suffix: str = "_ms") -> DataFrame:
    """Derive date columns from epoch-millisecond columns, then drop every ``*_ms`` column."""
    derived = {
        out: epoch_ms_date(F.col(quoted(ms))) for out, ms in dates.items() if ms in df.columns
    }
    return drop_suffix(df.withColumns(derived) if derived else df, suffix)


def dates_only(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Reduce the listed timestamp columns that exist to dates."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.col(quoted(name)).cast("date") for name in present})


def net_amount(df: DataFrame, price: str, fee: str, out: str) -> DataFrame:
    """``price - fee`` with nulls as 0, added only when both columns exist."""
    if price not in df.columns or fee not in df.columns:
        return df
    zero = F.lit(0.0)
    return df.withColumn(out, F.coalesce(F.col(quoted(price)), zero) - F.coalesce(F.col(quoted(fee)), zero))


def writable(df: DataFrame) -> DataFrame:
    """Columns without a type become string; zone-less timestamps become UTC instants."""
    fixes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NullType):
            fixes[field.name] = F.col(quoted(field.name)).cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType):
            fixes[field.name] = wall_clock_utc(F.col(quoted(field.name)))
    return df.withColumns(fixes) if fixes else df


def typed_as(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` to the names, order and types of a DDL column list."""
    target = T.StructType.fromDDL(ddl)
    return df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in target.fields])
