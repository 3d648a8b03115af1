"""Incremental loads driven by files arriving in a folder.

A run takes every file that arrived since the last one (``availableNow``) and ends; with no new
file it does nothing. The checkpoint remembers what was taken, and must lie on shared storage.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakemart import spec
from lakemart.functions.casts import quoted
from lakemart.operators.dedup import keep_last
from lakemart.operators.windows import scan_window
from lakemart.sources.files import Files
from lakemart.sources.landing import PARTITION
from lakemart.sources.tables import PartitionedTable


def arrivals(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str,
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files landing below ``path`` as a stream.

    With ``archive`` the files of a finished batch are moved there when a later batch runs.
    """
    Files(spark, path).ensure_folder(path)
    reader = spark.readStream.schema(schema).format(file_format).option("recursiveFileLookup", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def load_available(
    stream: DataFrame, load_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Hand all waiting records to ``load_batch`` and return when they are loaded."""
    query = (
        stream.writeStream.foreachBatch(load_batch).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def load_when_arrived(
    stream: DataFrame,
    load_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    poll_seconds: float = spec.ARRIVAL_POLL_SECONDS,
    give_up_seconds: float = spec.ARRIVAL_GIVE_UP_SECONDS,
) -> bool:
    """Look for files every ``poll_seconds`` and load the first that come; False when none came in time."""
    loaded: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id)
        loaded.append(batch_id)

    deadline = time.monotonic() + give_up_seconds
    while True:
        load_available(stream, load, checkpoint)
        if loaded or time.monotonic() + poll_seconds > deadline:
            return bool(loaded)
        time.sleep(poll_seconds)


def promote_available(stream: DataFrame, raw_root: str, ingestion_date: Column, checkpoint: str) -> None:
    """Append all waiting records to the raw zone under their ingestion date, each exactly once."""
    query = (
        stream.withColumn(PARTITION, ingestion_date).writeStream.format("parquet")
        .partitionBy(PARTITION).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(raw_root)
    )
    query.awaitTermination()


def upsert_available(
    stream: DataFrame,
    table: PartitionedTable,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    lookback_days: int | None = None,
) -> None:
    """Upsert all waiting records; a later arrival replaces an earlier one of the same key.

    Records without a key or a day are left out. With ``lookback_days``, so are records older than
    the table's watermark minus that many days.
    A batch repeated after a failure is known by the stream's id and its number and adds no load.
    """
    files = Files(table.spark, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = batch.dropna(subset=list({*keys, table.day}))
        if lookback_days is not None:
            rows = scan_window(rows, table.day, table.window_start(lookback_days))
        if not rows.isEmpty():
            stream_id = json.loads(files.text(f"{checkpoint}/metadata"))["id"]
            table.merge(keep_last(rows, keys, order_by), keys, batch=(stream_id, batch_id))

    load_available(stream, load, checkpoint)


def first_arrivals(
    stream: DataFrame, event_time: str, keys: Sequence[str], delay: str
) -> DataFrame:
    """Keep the first record per key while the event-time watermark still covers it."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_of_day(
    stream: DataFrame, event_time: str, keys: Sequence[str], order_by: Sequence[str], lookback: str
) -> DataFrame:
    """The last record per key and UTC day of its event time, as keyed state: in update mode a batch gives the days it changed.

    A record replaces the one in the state only if it is later by ``order_by``, in whatever batch it comes. Days that
    lie the lookback behind the greatest event time of earlier batches leave the state, and late records of theirs are left out.
    """
    day = F.window(event_time, "1 day")
    rest = [name for name in stream.columns if name not in keys]
    last = F.max_by(F.struct(*[F.col(quoted(name)) for name in rest]), F.struct(*[F.col(quoted(name)) for name in order_by]))
    return stream.withWatermark(event_time, lookback).groupBy(day.alias("_day"), *map(quoted, keys)).agg(last.alias("_last")).select(
        F.col("_day.start").cast("date").alias("day"), *map(quoted, keys), "_last.*")


def keep_latest_available(
    stream: DataFrame, table: PartitionedTable, event_time: str, keys: Sequence[str], order_by: Sequence[str],
    lookback: str, checkpoint: str,
) -> None:
    """Upsert the last record of each key and day from all waiting ones; ``table`` is kept by ``day``."""
    files = Files(table.spark, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            stream_id = json.loads(files.text(f"{checkpoint}/metadata"))["id"]
            table.merge(batch, ["day", *keys], batch=(stream_id, batch_id))

    load_available(latest_of_day(stream, event_time, keys, order_by, lookback), load, checkpoint, mode="update")
