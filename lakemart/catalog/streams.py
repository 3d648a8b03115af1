"""Arrival-driven loads: driver rows land as files, a stream takes them, the result table is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lakemart.catalog.core import DAILY_SQL
from lakemart.catalog.frames import SOURCE_FROM, daily_events
from lakemart.catalog.registry import Source, query
from lakemart.session import scratch_path
from lakemart.sources.tables import PartitionedTable
from lakemart.streaming.arrivals import (
    keep_latest_available, arrivals, first_arrivals, load_available, promote_available, upsert_available,
)

INGESTION = dt.date(2024, 2, 1)


@query("select event_id, event_type, value, date '2024-02-01' as ingestion_date from events")
def stream_arrivals(source: Source) -> DataFrame:
    """Events land twice over time; each file is taken once, and a run without new files adds nothing."""
    root = scratch_path(source.spark, "arrivals")
    rows = source.events.select("event_id", "event_type", "value")
    stream = arrivals(source.spark, f"{root}/inbox", rows.schema, "parquet")
    for part in (F.col("event_type") == "click", F.col("event_type") != "click", None):
        if part is not None:
            rows.where(part).write.mode("append").parquet(f"{root}/inbox")
        promote_available(stream, f"{root}/raw", F.lit(INGESTION), f"{root}/checkpoint")
    return source.spark.read.parquet(f"{root}/raw")


def daily_table(source: Source, root: str, drops: list[DataFrame], lookback_days: int | None) -> DataFrame:
    table = PartitionedTable(source.spark, f"{root}/table", "data")
    stream = arrivals(source.spark, f"{root}/inbox", drops[0].schema, "parquet")
    for drop in drops:
        drop.write.mode("append").parquet(f"{root}/inbox")
        upsert_available(
            stream, table, ["data", "user_id"], ["ts", "event_id"], f"{root}/checkpoint", lookback_days
        )
    return table.read().select("data", "user_id", "event_id", "event_type", "value")


@query(f"""
    with last as ({DAILY_SQL})
    select data, user_id, event_id, event_type,
           case when data >= date '2024-01-11' then value * 2 else value end as value from last
""")
def stream_upsert(source: Source) -> DataFrame:
    """The first drop holds every day, the second restates the later ones."""
    days = daily_events(source)
    restated = days.where(F.col("data") >= F.lit(SOURCE_FROM)).withColumn("value", F.col("value") * 2)
    return daily_table(source, scratch_path(source.spark, "upserts"), [days, restated], None)


@query(f"select data, user_id, event_id, event_type, value, 1::bigint as loads from ({DAILY_SQL})")
def replayed_upsert(source: Source) -> DataFrame:
    """A batch that the stream repeats, as after a failure before its checkpoint, adds no load."""
    root, days = scratch_path(source.spark, "replayed"), daily_events(source)
    table = PartitionedTable(source.spark, f"{root}/table", "data")
    days.write.parquet(f"{root}/inbox")
    stream = arrivals(source.spark, f"{root}/inbox", days.schema, "parquet")
    for _ in range(2):
        upsert_available(stream, table, ["data", "user_id"], ["ts", "event_id"], f"{root}/checkpoint")
        # Without its commit the batch counts as not taken.
        table.files.delete(f"{root}/checkpoint/commits/0")
    return table.read().select("data", "user_id", "event_id", "event_type", "value").withColumn("loads", F.lit(len(table.loads())).cast("bigint"))


@query(f"""
    with last as ({DAILY_SQL})
    select data, user_id, event_id, event_type,
           case when data >= date '2024-01-10' then value * 2 else value end as value from last
""")
def late_window(source: Source) -> DataFrame:
    """The second drop restates everything; only days within 10 of the watermark (Jan 20) count."""
    days = daily_events(source)
    first = days.where(F.col("data") <= F.lit(dt.date(2024, 1, 20)))
    restated = days.withColumn("value", F.col("value") * 2)
    return daily_table(source, scratch_path(source.spark, "late"), [first, restated], 10)


@query("select user_id, event_type, min(ts) as ts from events group by all")
def first_arrival_keys(source: Source) -> DataFrame:
    """First-wins deduplication: the earliest event of each key arrives first, in a file of its own, and stays."""
    root = scratch_path(source.spark, "firsts")
    rows = source.events.select("ts", "user_id", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    stream = arrivals(source.spark, f"{root}/inbox", rows.schema, "parquet")
    kept = first_arrivals(stream, "ts", ["user_id", "event_type"], "60 days")

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/kept/batch={batch_id}")

    first = rows.groupBy("user_id", "event_type").agg(F.min("ts").alias("ts"))
    for arriving in (rows.join(first, ["user_id", "event_type", "ts"]), rows):
        arriving.select(rows.columns).write.mode("append").parquet(f"{root}/inbox")
        load_available(kept, append, f"{root}/checkpoint")
    return source.spark.read.schema(rows.schema).parquet(f"{root}/kept").select(
        "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""
    with drops as (
        select 1 as revision, ts, user_id, event_id, event_type, value from events where ts < timestamp '2024-01-21'
        union all select 2, ts, user_id, event_id, event_type, value * 2 from events
        where ts >= timestamp '2024-01-11' and ts < timestamp '2024-01-26'
        union all select 3, ts, user_id, event_id, event_type, value * 3 from events where event_id % 2 = 0),
    -- The third drop comes behind a watermark: whole days before it are late.
    behind as (select max(ts) - interval 10 day as mark from events where ts < timestamp '2024-01-26'),
    taken as (select * from drops, behind where revision < 3 or cast(ts as date) + interval 1 day > mark)
    select cast(ts as date) as day, user_id, revision::bigint as revision, event_id, event_type, value from taken
    qualify row_number() over (partition by cast(ts as date), user_id order by revision desc, ts desc, event_id desc) = 1
""")
def streaming_keep_last(source: Source) -> DataFrame:
    """Three batches through keyed state: new days, a restated window, and a restatement of half of everything, partly late."""
    root = scratch_path(source.spark, "latest")
    rows = source.events.select(
        F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_id", "event_type", "value")
    drops = [
        rows.where("ts < timestamp'2024-01-21'"),
        rows.where("ts >= timestamp'2024-01-11' and ts < timestamp'2024-01-26'").withColumn("value", F.col("value") * 2),
        rows.where("event_id % 2 = 0").withColumn("value", F.col("value") * 3),
    ]
    drops = [drop.withColumn("revision", F.lit(i + 1).cast("bigint")) for i, drop in enumerate(drops)]
    table = PartitionedTable(source.spark, f"{root}/table", "day")
    stream = arrivals(source.spark, f"{root}/inbox", drops[0].schema, "parquet")
    for drop in drops:
        drop.write.mode("append").parquet(f"{root}/inbox")
        keep_latest_available(stream, table, "ts", ["user_id"], ["revision", "ts", "event_id"], "10 days", f"{root}/checkpoint")
    return table.read().select("day", "user_id", "revision", "event_id", "event_type", "value")
