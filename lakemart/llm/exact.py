"""Exact duplicates by a stateful stream whose keyed state lives on disk and never expires.

Texts are equal when they are identical after every run of white space became one blank. Per digest
of that text the state retains the digest, the stable identifier (the smallest id) and the content
locator (the row of the fingerprint table that holds the identifier), and the number of rows. The
state is a RocksDB store below ``state_path``: later loads go on from it, and it is read back as a
table by Spark's state reader. A digest with several rows is a hit: the full texts behind it are
compared, and where they differ the rows are grouped by the text itself.

All of it is DataFrame and SQL functions.

Defined results: a null text is the empty text; a very long text is digested and compared whole; a null id counts as larger than every id; of repeated
rows (same id and text) exactly one is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.llm.common import apply_verdicts, name_of, one_blank, split_by_bucket, stored, stored_at, text_of
from lakemart.session import scratch_path

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Else every store reserves megabytes for files it hardly fills.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
BATCH_BYTES = 8 * 2**30


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rank(identifier: Column, locator: Column) -> Column:
    """Orders rows by id, nulls last, then by place."""
    return F.struct(identifier.isNull().alias("absent"), identifier.alias("id"), locator.alias("locator"))


def fingerprints(
    docs: DataFrame, id_column: str, text_column: str, digest: Callable[[Column], Column],
) -> tuple[DataFrame, str]:
    """One row per document: id, digest, locator. Written once, so the locator stays fixed."""
    found = docs.select(
        name_of(id_column).alias("id"), digest(one_blank(text_of(text_column))).alias("digest"),
        F.monotonically_increasing_id().alias("locator"),
    )
    return stored_at(found, "fingerprints")


class DedupState:
    """The keyed state below ``state_path``; one writer at a time."""

    def __init__(self, spark: SparkSession, state_path: str):
        self.state_path = state_path
        # A session of its own: the stream's settings do not reach the caller's queries.
        self.session = spark.newSession()
        for key, value in STATE_SETTINGS.items():
            self.session.conf.set(key, value)
        for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            self.session.conf.set(key, spark.conf.get(key))

    def add(self, folder: str, schema: StructType, batch_bytes: int = BATCH_BYTES) -> None:
        """Take in the fingerprint files of ``folder`` that the state has not seen, in bounded batches."""
        rows = self.session.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(folder)
        query = (_grouped(rows, "digest").writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", self.state_path).start())
        query.awaitTermination()

    def groups(self) -> DataFrame:
        """digest, first (absent, id, locator), n: one row per distinct digest seen so far."""
        state = self.session.read.format("statestore").load(self.state_path)
        first, n = (field.name for field in state.schema["value"].dataType.fields[-2:])
        return state.select(
            F.col("key.digest").alias("digest"), F.col("value")[first].alias("first"), F.col("value")[n].alias("n"),
        )


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per row: id, digest, keep_id, group_size, kept."""
    spark = docs.sparkSession
    prints, folder = fingerprints(docs, id_column, text_column, digest)
    if prints.isEmpty():
        return _decided(prints, _grouped(prints, "digest"))
    state = DedupState(spark, scratch_path(spark, "dedup-state"))
    state.add(folder, prints.schema, batch_bytes)
    groups = spark.read.parquet(stored_at(state.groups(), "dedup-groups")[1])

    # A hit: compare the full texts behind the digest. Rows without a hit are left out before the shuffle
    # by the digest's bucket, a list that cannot outgrow BUCKETS; buckets shared by chance only cost
    # the move of a text. One group is one row per task after the partial aggregate.
    text = one_blank(text_of(text_column))
    texts = docs.select(name_of(id_column).alias("id"), text.alias("content"), digest(text).alias("digest"))
    hits, _ = split_by_bucket(texts.select("content", "digest"), F.col("digest"), groups.where("n > 1"), F.col("digest"))
    unequal = (hits
               .groupBy("digest").agg(F.min("content").alias("least"), F.max("content").alias("most"))
               .where("least != most").select("digest"))
    unequal = stored(unequal, "dedup-unequal")
    rows = _decided(prints, groups)
    if not unequal.isEmpty():
        rows = _decided(prints.join(unequal, "digest", "left_anti"), groups).unionByName(
            _by_content(texts.join(unequal, "digest", "left_semi")))
    return rows


def _grouped(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.min(_rank(F.col("id"), F.col("locator"))).alias("first"), F.count(F.lit(1)).alias("n"))


def _decided(prints: DataFrame, groups: DataFrame) -> DataFrame:
    return prints.join(groups, "digest").select(
        "id", "digest", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("first.locator") == F.col("locator")).alias("kept"),
    )


def _by_content(texts: DataFrame) -> DataFrame:
    """The rows of digests that stand for several texts, grouped by the text itself."""
    placed = stored(texts.withColumn("locator", F.monotonically_increasing_id()), "dedup-collided")
    return placed.join(_grouped(placed, "content"), "content").select(
        "id", "digest", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("first.locator") == F.col("locator")).alias("kept"),
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts."""
    verdicts = exact_groups(docs, id_column, text_column).select("id", F.col("digest").alias("mark"), "kept")
    return apply_verdicts(docs, verdicts, id_column, sha256(one_blank(text_of(text_column))), once=True)
