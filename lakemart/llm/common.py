"""Helpers the operators of this folder share."""

from __future__ import annotations

import pathlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemart.session import scratch_path

#: White space of the word and text rules: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Runs of white space that are not already one blank: replacing only these leaves the rest untouched.
UNEVEN_BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 8 * 2**20


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the Python path of the workers, and hand them rows in batches of bounded size.

    The first is needed where the package is not installed but only on the driver's own path, as in a local session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    folder, environment = str(pathlib.Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    before = environment.get("PYTHONPATH", "")
    if folder not in before.split(":"):
        environment["PYTHONPATH"] = f"{folder}:{before}".rstrip(":")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once, written to the shared scratch folder and read back.

    A lost executor then costs a reread, and each consumer reads only its own columns. The folder
    belongs to the session's ``spark.checkpoint.dir``, whose owner clears it.
    """
    return stored_at(df, label)[0]


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``stored`` together with the folder it wrote."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def name_of(column: str) -> Column:
    """The column of exactly that name, dots and blanks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, lengthened until no column of ``taken`` has it (names compare without case)."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def text_of(column: str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(name_of(column).cast("string"), F.lit(""))


def one_blank(text: Column) -> Column:
    """Every run of white space as one blank."""
    return F.regexp_replace(text, UNEVEN_BLANKS, " ")


#: How many buckets a broadcast list of buckets can hold at most.
BUCKETS = 2**20


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def split_by_bucket(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key of ``wanted``, rows that surely have none), decided without a shuffle.

    Only the buckets of the wanted keys are broadcast, at most ``BUCKETS`` numbers. Rows that share a
    bucket by chance are in the first frame too, so what follows must still compare keys.
    """
    bucket = free_name("key_bucket", rows.columns)
    listed = stored(wanted.select(bucket_of(wanted_key).alias(bucket)).distinct(), "buckets")
    marked = rows.withColumn(bucket, bucket_of(key))
    return (marked.join(F.broadcast(listed), bucket, "left_semi").drop(bucket),
            marked.join(F.broadcast(listed), bucket, "left_anti").drop(bucket))



def apply_verdicts(docs: DataFrame, verdicts: DataFrame, id_column: str, mark: Column, once: bool) -> DataFrame:
    """The rows of ``docs`` that a stage keeps, with all their columns.

    ``verdicts`` has id, mark (a digest of the text, the value ``mark`` takes in ``docs``) and kept. Only
    rows that share a bucket with a dropped one are moved. With ``once``, rows that repeat id and mark
    stay once where one of them is kept; otherwise all of them do.
    """
    names = docs.columns
    own, their_id, their_mark, stays = (free_name(name, names) for name in ("row_mark", "verdict_id", "verdict_mark", "verdict"))
    found = verdicts.groupBy(F.col("id").alias(their_id), F.col("mark").alias(their_mark)).agg(
        F.max("kept").alias(stays), F.count(F.lit(1)).alias("rows"))
    changed = F.expr(f"not {stays} or rows > 1") if once else ~F.col(stays)
    found = stored(found.where(changed).drop("rows"), "verdicts")
    marked = docs.withColumn(own, mark)
    maybe, sure = split_by_bucket(
        marked, F.struct(name_of(id_column), F.col(own)), found, F.struct(F.col(their_id), F.col(their_mark)))
    judged = maybe.join(found, name_of(id_column).eqNullSafe(F.col(their_id)) & (F.col(own) == F.col(their_mark)), "left")
    kept = sure.select(*map(name_of, names)).unionByName(judged.where(F.col(stays).isNull()).select(*map(name_of, names)))
    if once:
        kept = kept.unionByName(judged.where(stays).dropDuplicates([id_column, own]).select(*map(name_of, names)))
    return kept
