"""High watermarks, lookback windows and date slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions.casts import quoted

FLOOR = dt.date(1970, 1, 1)


def high_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row with the greatest value of ``column``."""
    return df.agg(F.max(quoted(column)).alias("watermark"))


def window_start_column(watermark: Column, lookback_days: int, floor: dt.date = FLOOR) -> Column:
    return F.coalesce(F.date_sub(watermark, lookback_days), F.lit(floor))


def window_start(watermark: dt.date | None, lookback_days: int, floor: dt.date = FLOOR) -> dt.date:
    """First day to reprocess; ``floor`` when the target holds nothing yet."""
    return floor if watermark is None else watermark - dt.timedelta(days=lookback_days)


def scan_window(df: DataFrame, column: str, start: dt.date | Column) -> DataFrame:
    """Rows with ``column >= start``; a literal or scalar-subquery bound prunes partitions."""
    return df.where(F.col(quoted(column)) >= (start if isinstance(start, Column) else F.lit(start)))


def load_window(
    watermark: dt.date | None,
    lookback_days: int,
    backfill_days: int,
    end: dt.date,
    explicit: tuple[dt.date | None, dt.date | None] = (None, None),
) -> tuple[dt.date, dt.date]:
    """First and last day to extract.

    An explicit pair wins; a lone explicit start counts only while there is no watermark.
    """
    first, last = explicit
    if first and last:
        return first, last
    if watermark is not None:
        return watermark - dt.timedelta(days=lookback_days), end
    return first or end - dt.timedelta(days=backfill_days), end


def date_slices(bounds: DataFrame, first: str, last: str, days: int) -> DataFrame:
    """Closed slices of ``days`` days tiling each row's [first, last]; none when first > last."""
    step = F.make_interval(days=F.lit(days))
    ordered = bounds.where(F.col(quoted(first)) <= F.col(quoted(last)))
    return ordered.select(
        F.explode(F.sequence(F.col(quoted(first)), F.col(quoted(last)), step)).alias("slice_start"),
        F.col(quoted(last)).alias("_last"),
    ).select(
        "slice_start", F.least(F.date_add("slice_start", days - 1), F.col("_last")).alias("slice_end")
    )


def slice_number(day: Column, first: Column, days: int) -> Column:
    """Index of the slice a day falls into."""
    return F.floor(F.datediff(day, first) / F.lit(days))
