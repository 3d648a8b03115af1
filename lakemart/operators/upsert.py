"""The write strategies as plain functions of (target, source).

They build the new table content; ``lakemart.sources.tables`` decides which files that touches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions.casts import quoted
from lakemart.operators.dedup import keep_last
from lakemart.operators.projection import select_present


_IN_SOURCE, _SOURCE = "_in_source", "_source_"


def _as_target(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source's columns in the target's types; columns the target lacks are refused."""
    extra = [name for name in source.columns if name not in target.columns]
    if extra:
        raise ValueError(f"source columns unknown to the target: {extra}")
    return source.select(*[
        F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields if f.name in source.columns
    ])


def merge_rows(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], keep_where_null: Sequence[str] = (), scanned: bool = False
) -> DataFrame:
    """Upsert: matched rows are replaced by the source row, unmatched source rows are added.

    One full outer join, so both sides are read once. ``source`` holds one row per key (see
    ``require_unique``). A null key matches nothing, so it is always added. Columns the source lacks
    keep their target value, and so do those of ``keep_where_null`` where the source's is null. A source that is a
    plain scan (``scanned``) and has all columns is read once for its keys, which tell the target rows that stay, and
    once as it is: its rows are then not moved to be joined.
    """
    if target is None:
        return source
    typed = _as_target(target, source)
    same = [F.col(quoted(name)) == F.col(quoted(_SOURCE + name)) for name in keys]
    if scanned and not keep_where_null and typed.columns == target.columns:
        known = typed.select(*[F.col(quoted(name)).alias(_SOURCE + name) for name in keys])
        return target.join(known, same, "left_anti").union(typed)
    new = typed.select(
        *[F.col(quoted(name)).alias(_SOURCE + name) for name in typed.columns], F.lit(True).alias(_IN_SOURCE))
    met = target.join(new, same, "full_outer")
    replaced = F.col(_IN_SOURCE).isNotNull()

    def value(name: str) -> Column:
        old, fresh = F.col(quoted(name)), F.col(quoted(_SOURCE + name))
        if name not in typed.columns:
            return old
        return F.when(replaced, F.coalesce(fresh, old) if name in keep_where_null else fresh).otherwise(old).alias(name)

    return met.select(*[value(name) for name in target.columns])


def reload_rows(
    target: DataFrame | None, source: DataFrame, column: str, start: dt.date | Column
) -> DataFrame:
    """Drop the target rows with ``column >= start`` and add the source; null dates stay.

    The source takes the target's types; columns it lacks are null, columns the target lacks are refused.
    """
    if target is None:
        return source
    source = _as_target(target, source)
    bound = start if isinstance(start, Column) else F.lit(start)
    in_window = F.coalesce(F.col(quoted(column)) >= bound, F.lit(False))
    return target.where(~in_window).unionByName(source, allowMissingColumns=True)


def dimension_rows(
    source: DataFrame, key: Sequence[str], columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The latest attributes per key, rows with a null key left out.

    Equal ``order_by`` values are settled by the attributes themselves, so the choice is stable. Rows that
    repeat all attributes are one before they are compared, as most of a fact's rows do.
    """
    complete = source.dropna(subset=[name for name in key])
    attributes = [name for name in columns if name in source.columns]
    ties = [name for name in attributes if name not in key and name not in order_by]
    wanted = select_present(complete, dict.fromkeys([*attributes, *order_by]))
    if len(order_by) == 1 and order_by[0] not in attributes:
        wanted = wanted.groupBy(*map(quoted, attributes)).agg(F.max(quoted(order_by[0])).alias(order_by[0]))
    return select_present(keep_last(wanted, key, [*order_by, *ties]), attributes)


def scd1(
    dimension: DataFrame | None,
    source: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """Type-1 dimension: latest attributes per key, merged over the existing dimension."""
    return merge_rows(dimension, dimension_rows(source, key, columns, order_by), key)
