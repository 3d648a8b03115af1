"""Landing zone: staging by event day, promotion to raw, and the typed raw readers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakemart.functions.casts import quoted
from lakemart.operators.quality import GateError
from lakemart.sources.files import Files

PARTITION = "ingestion_date"
ARRIVAL = "_arrival"
ARRIVAL_TYPE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("row", T.LongType()),
])
# Name prefixes of drafts and lock files left in an inbox.
IGNORED_PREFIXES = ("+", "~")


def raw_partition(root: str, ingestion_date: dt.date) -> str:
    return f"{root.rstrip('/')}/{PARTITION}={ingestion_date.isoformat()}"


# ---- staging and promotion ---------------------------------------------------------------


def stage_by_day(df: DataFrame, root: str, day: str, file_format: str = "json") -> None:
    """Write records (JSON as lines), one folder per event day, replacing only the days written.

    The rebalance hint keeps a small day in one file and splits a hot one.
    """
    (
        df.where(F.col(quoted(day)).isNotNull()).hint("rebalance", F.col(quoted(day)))
        .write.partitionBy(day).mode("overwrite").option("partitionOverwriteMode", "dynamic").format(file_format).save(root)
    )


def promote(
    spark: SparkSession, stage_root: str, raw_root: str, ingestion_date: dt.date, extensions: Sequence[str]
) -> int:
    """Move what is staged under ``ingestion_date=<day>``; returns the number of entries moved.

    An entry is a file of the given types or a day folder. Entries are renamed, so bytes are kept as
    they landed and a repeated run moves only what is left; an entry of the same name already
    promoted that day is replaced. The first promotion of a day is one rename of the whole folder.
    """
    stage_root, target = stage_root.rstrip("/"), raw_partition(raw_root, ingestion_date)
    files = Files(spark, stage_root)
    visible = [entry for entry in files.children(stage_root) if not entry[0].startswith(("_", "."))]
    names = [name for name, is_directory in visible if is_directory or has_extension(name, extensions)]
    if not names:
        return 0
    if len(names) == len(visible) and not files.exists(target):
        files.move(stage_root, target)
        files.ensure_folder(stage_root)
    else:
        for name in names:
            files.move(f"{stage_root}/{name}", f"{target}/{name}")
    return len(names)


# ---- selecting files ---------------------------------------------------------------------


def has_extension(name: str, extensions: Sequence[str]) -> bool:
    return name.lower().endswith(tuple(extensions))


def _extension_matches(name: Column, extensions: Sequence[str]) -> Column:
    lowered = F.lower(name)
    matches = F.lit(False)
    for extension in extensions:
        matches = matches | lowered.endswith(extension)
    return matches


def is_inbox_file(name: Column, extensions: Sequence[str]) -> Column:
    """A file of the given types (any case) that is neither a draft nor a lock file.

    On ``_metadata.file_name`` this prunes files before they are opened.
    """
    ignored = F.lit(False)
    for prefix in IGNORED_PREFIXES:
        ignored = ignored | name.startswith(prefix)
    return _extension_matches(name, extensions) & ~ignored


def latest_drop_path(
    spark: SparkSession, root: str, extensions: Sequence[str], first_only: bool = False
) -> str | None:
    """The allowed entry of the newest ``ingestion_date`` that has one; None without any.

    An entry is a file, or a folder written by Spark under a file's name. Only folder names are
    listed, newest first, and the search ends at the first hit. A drop of several entries is refused,
    since a load reads one; ``first_only`` takes the first by name and leaves the others unread.
    """
    files, root = Files(spark, root), root.rstrip("/")
    days = [name for name, is_directory in files.children(root) if is_directory and name.startswith(PARTITION + "=")]
    for day in sorted(days, reverse=True):
        entries = sorted(name for name, _ in files.children(f"{root}/{day}") if has_extension(name, extensions))
        if len(entries) > 1 and not first_only:
            raise GateError(f"{root}/{day} holds several drops: {', '.join(entries)}")
        if entries:
            return f"{root}/{day}/{entries[0]}"
    return None


# ---- readers -----------------------------------------------------------------------------


def read_partition(
    spark: SparkSession,
    root: str,
    ingestion_date: dt.date,
    schema: T.StructType | str | None,
    file_format: str = "json",
    arrays: bool = False,
) -> DataFrame:
    """Records of exactly one ingestion date; none when that partition is missing.

    Without a schema the fields are those the partition's records have, found by reading it once more.

    ``arrays`` reads files that are one JSON array each; such a file is one task, so large drops
    should arrive as JSON lines, which Spark splits. A malformed file fails the load. The added ``_arrival`` column is the position
    of the record in the landing files, for keep-last in file order: path below the partition,
    offset of the split, row within it.
    """
    path = raw_partition(root, ingestion_date)
    if not Files(spark, path).exists(path):
        landed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema or T.StructType()
        return spark.createDataFrame([], T.StructType([*landed.fields, T.StructField(ARRIVAL, ARRIVAL_TYPE)]))
    any_case = "".join(f"[{letter}{letter.upper()}]" for letter in file_format)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{any_case}")
    reader = reader.schema(schema) if schema else reader
    if file_format == "json":
        reader = reader.option("multiLine", arrays).option("mode", "FAILFAST")
    records = reader.format(file_format).load(path)
    position = F.struct(
        F.substring_index("_metadata.file_path", f"{PARTITION}={ingestion_date.isoformat()}/", -1).alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )
    return records.select("*", position.alias(ARRIVAL))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header. Without a schema every column is text under its header name.

    Quotes inside a quoted value are doubled. A row that does not fit fails the load. ``multi_line``
    allows line breaks inside quotes; such a file is one task, so it is for files dropped by hand.
    A missing value is null and a quoted empty one is empty text: Spark would read both as null, so
    the marker of a missing value is set to something no file holds.
    """
    reader = (spark.read.option("header", "true").option("nullValue", "\u0000").option("escape", '"')
              .option("mode", "FAILFAST").option("multiLine", multi_line))
    return (reader.schema(schema).option("enforceSchema", "false") if schema else reader).csv(path)


def read_drop(
    spark: SparkSession,
    path: str,
    sheet: str | None = None,
    decode: Callable[[bytes], pd.DataFrame] | None = None,
) -> DataFrame:
    """A dropped file by its extension, every column it has as text: CSV by Spark, a workbook decoded."""
    if has_extension(path, [".csv"]):
        return read_csv(spark, path, multi_line=True)
    decode = decode or excel_sheet(sheet)
    columns = workbook_columns(spark, path, decode)
    return read_workbooks(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in columns]), decode)


def excel_sheet(sheet: str | None) -> Callable[[bytes], pd.DataFrame]:
    """Decoder of one named sheet, or the first; pandas needs an Excel engine on the executors."""
    def decode(content: bytes) -> pd.DataFrame:
        import io

        return pd.read_excel(io.BytesIO(content), sheet_name=0 if sheet is None else sheet, dtype=object)

    return decode


def _books(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("content")


def workbook_columns(spark: SparkSession, path: str, decode: Callable[[bytes], pd.DataFrame]) -> list[str]:
    """Column names of the workbooks below ``path``, in sheet order."""
    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                found = [str(name) for name in decode(content).columns]
                yield pd.DataFrame({"position": range(len(found)), "name": found})

    listed = _books(spark, path).mapInPandas(names, "position bigint, name string")
    ordered = listed.groupBy("name").agg(F.min("position").alias("position")).orderBy("position", "name")
    return [row["name"] for row in ordered.collect()]


def read_workbooks(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    decode: Callable[[bytes], pd.DataFrame],
) -> DataFrame:
    """Rows of every workbook below ``path``; ``decode`` turns the bytes of one into a frame.

    Workbooks spread over tasks; one workbook is never split. A sheet lacking a schema column
    fails the load. Cells of a text column become text whatever type they have in the sheet.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = target.fieldNames()
    texts = [field.name for field in target.fields if isinstance(field.dataType, T.StringType)]

    def decode_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = decode(content).rename(columns=str)[names]
                yield rows.astype(dict.fromkeys(texts, "string"))

    return _books(spark, path).mapInPandas(decode_batch, target)
