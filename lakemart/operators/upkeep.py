"""Maintenance decisions over file and version listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions.casts import quoted

SMALL_FILE_BYTES = 32 * 1024 * 1024
TARGET_FILE_BYTES = 256 * 1024 * 1024


def compaction_plan(
    files: DataFrame,
    by: Sequence[str],
    size: str = "length",
    small_bytes: int = SMALL_FILE_BYTES,
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Directories worth rewriting: more than one small file, and fewer files after the rewrite."""
    return (
        files.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.count_if(F.col(size) < small_bytes).alias("small_files"),
            F.sum(size).alias("bytes"),
        )
        .withColumn("files_after", F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1).cast("bigint")))
        .where("small_files > 1 and files_after < files")
    )


def expired_versions(
    versions: DataFrame, now: dt.datetime | Column, retention_hours: int, by: Sequence[str] = ()
) -> DataFrame:
    """Versions no longer needed to read any state of the last ``retention_hours`` hours.

    ``versions`` has ``version`` and ``committed_at``. The newest version committed before the cutoff
    was the current one at the cutoff, so it stays, and so does everything after it.
    """
    clock = now if isinstance(now, Column) else F.lit(now)
    cutoff = clock - F.make_dt_interval(hours=F.lit(retention_hours))
    committed_before = F.when(F.col("committed_at") <= cutoff, F.col("version"))
    floor = versions.groupBy(*by).agg(F.max(committed_before).alias("oldest_kept"))
    if by:
        joined = versions.join(floor, list(by))
    else:
        joined = versions.withColumn("oldest_kept", floor.scalar())
    return joined.where("version < oldest_kept").drop("oldest_kept")


def interleaved(columns: Sequence[Column], bits: int) -> Column:
    """Whole numbers of so many bits woven into one, the first column's bit ahead of the others' at each place."""
    woven = F.lit(0).cast("bigint")
    for place in range(bits):
        for i, column in enumerate(columns):
            bit = F.shiftright(column.cast("bigint"), place).bitwiseAND(F.lit(1).cast("bigint"))
            woven = woven + F.shiftleft(bit, place * len(columns) + len(columns) - 1 - i)
    return woven


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = 8, accuracy: float = 0.001) -> DataFrame:
    """``df`` in ``files`` ranges of a space-filling order over numeric columns, sorted inside.

    A column is ranked by its quantiles first, so that skew does not fill one corner. Files, and row groups in
    them, then span little of any of the columns, and a filter on either skips most of them. Nulls come first.
    """
    steps = [i / 2**bits for i in range(1, 2**bits)]
    bounds = df.select(*[F.col(quoted(name)).cast("double").alias(f"c{i}") for i, name in enumerate(columns)]).approxQuantile(
        [f"c{i}" for i in range(len(columns))], steps, accuracy)

    def rank(name: str, limits: list[float]) -> Column:
        limits = sorted(set(limits))
        value = F.col(quoted(name)).cast("double")
        # Where the value would go among the bounds; a null is before all of them.
        place = F.aggregate(F.array(*map(F.lit, limits)), F.lit(0), lambda total, limit: total + (value >= limit).cast("int"))
        return F.coalesce(place, F.lit(0))

    order = interleaved([rank(name, limits) for name, limits in zip(columns, bounds)], bits)
    ranked = df.withColumn("_order", order)
    return ranked.repartitionByRange(files, "_order").sortWithinPartitions("_order", *map(quoted, columns)).drop("_order")
