"""Lenient casts and date conversions that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Number spellings Java accepts but a data-frame parser does not: hex, a d/f suffix, outer blanks.
_JAVA_ONLY_NUMBER = r"(?i)0x|[0-9.][df]$|^\s|\s$"

MS_PER_DAY = 86_400_000


def _number_from_text(text: Column, target: str) -> Column:
    return F.when(~text.rlike(_JAVA_ONLY_NUMBER), text.try_cast(target))


def lenient_double(text: Column) -> Column:
    """Text to double; anything unparsable is null."""
    return _number_from_text(text, "double")


def lenient_long(text: Column) -> Column:
    """Text to bigint; anything unparsable, fractions included, is null."""
    return _number_from_text(text, "bigint")


def lenient_whole(text: Column) -> Column:
    """Text to bigint, a fraction cut off; for numbers that landed as text only to keep them all."""
    return F.coalesce(lenient_long(text), lenient_double(text).try_cast("bigint"))


def lenient_cast(df: DataFrame, types: dict[str, T.DataType], cut_fractions: bool = False) -> DataFrame:
    """Cast the listed columns that ``df`` has; values that do not fit become null.

    With ``cut_fractions`` text such as ``9.9`` becomes the bigint 9 instead of null.
    """
    replaced = {}
    for field in df.schema.fields:
        target = types.get(field.name)
        if target is None:
            continue
        column = F.col(quoted(field.name))
        if not isinstance(field.dataType, T.StringType) or not isinstance(target, (T.DoubleType, T.LongType)):
            replaced[field.name] = column.try_cast(target)
        elif isinstance(target, T.LongType):
            replaced[field.name] = lenient_whole(column) if cut_fractions else lenient_long(column)
        else:
            replaced[field.name] = lenient_double(column)
    return df.withColumns(replaced) if replaced else df


def epoch_ms_date(ms: Column) -> Column:
    """UTC calendar day of an epoch-millisecond value."""
    per_day = F.lit(MS_PER_DAY).cast("bigint")
    # ``div`` cuts towards zero; a day before 1970 that has begun counts.
    day = F.call_function("div", ms, per_day) - F.when(ms % per_day < 0, 1).otherwise(0)
    return F.date_from_unix_date(day.cast("int"))


def date_epoch_ms(day: Column) -> Column:
    """Epoch milliseconds of UTC midnight."""
    return F.unix_date(day).cast("bigint") * F.lit(MS_PER_DAY)


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; anything else is null."""
    return F.try_to_date(text, "yyyy-MM-dd")


def wall_clock_utc(naive: Column) -> Column:
    """A zone-less timestamp as the instant that shows the same wall clock in UTC."""
    naive_epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc_epoch = F.lit(dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc))
    return utc_epoch + (naive - naive_epoch)


def quoted(name: str) -> str:
    """A column name that may hold dots, spaces or back-ticks, ready for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"
