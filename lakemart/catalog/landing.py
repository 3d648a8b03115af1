"""Landing readers and writers: each query writes driver rows as files, then reads them its own way."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lakemart.catalog.frames import daily_events
from lakemart.catalog.registry import Source, query
from lakemart.session import scratch_path
from lakemart.sources.files import Files, file_listing
from lakemart.sources.landing import (
    ARRIVAL, is_inbox_file, latest_drop_path, promote, raw_partition, read_csv, read_partition, stage_by_day,
)

FIRST, SECOND, THIRD = dt.date(2024, 2, 1), dt.date(2024, 2, 2), dt.date(2024, 2, 3)


def restated_events(source: Source, factor: int) -> DataFrame:
    days = daily_events(source).withColumn("value", F.col("value") * factor)
    return days.select("event_id", "user_id", "event_type", "value", F.col("data").alias("event_date"))


@query("select event_id, user_id, event_type, value * 2 as value from events")
def landing_partition(source: Source) -> DataFrame:
    """Two ingestion dates; the run reads its own one only."""
    root = scratch_path(source.spark, "landing")
    rows = restated_events(source, 1)
    for factor, ingestion_date in ((1, FIRST), (2, SECOND)):
        stage_by_day(restated_events(source, factor), f"{root}/stage", "event_date")
        promote(source.spark, f"{root}/stage", f"{root}/raw", ingestion_date, [".json"])
    schema = rows.drop("event_date").schema
    return read_partition(source.spark, f"{root}/raw", SECOND, schema).drop(ARRIVAL)


@query("select cast(ts as date) as event_date, count(*) as records from events group by 1")
def daily_partition_counts(source: Source) -> DataFrame:
    """Records staged per event day, counted from the day folders."""
    root = scratch_path(source.spark, "staged-days")
    stage_by_day(restated_events(source, 1), root, "event_date")
    staged = source.spark.read.schema("event_id bigint, event_date date").json(root)
    return staged.groupBy("event_date").agg(F.count(F.lit(1)).alias("records"))


@query("select event_id, event_type, value, date '2024-02-01' as ingestion_date from events")
def promote_ingestion_date(source: Source) -> DataFrame:
    """Everything staged moves below its ingestion date; a second promotion finds nothing left."""
    root = scratch_path(source.spark, "promoted")
    stage_by_day(restated_events(source, 1), f"{root}/stage", "event_date")
    for ingestion_date in (FIRST, SECOND):
        promote(source.spark, f"{root}/stage", f"{root}/raw", ingestion_date, [".json"])
    schema = "event_id bigint, event_type string, value double, ingestion_date date, event_date date"
    return source.spark.read.schema(schema).json(f"{root}/raw").drop("event_date")


@query("""
    select c_custkey, 'a "' || c_name || '", b' as c_name, c_mktsegment || chr(10) || 'second line' as c_mktsegment, c_acctbal
    from customer
""")
def csv_scan(source: Source) -> DataFrame:
    """Values with quotes, commas and line breaks."""
    path = scratch_path(source.spark, "csv")
    rows = source.customer.select(
        "c_custkey", F.concat(F.lit('a "'), "c_name", F.lit('", b')).alias("c_name"),
        F.concat("c_mktsegment", F.lit("\nsecond line")).alias("c_mktsegment"), "c_acctbal")
    rows.write.option("header", "true").option("escape", '"').csv(path)
    return read_csv(source.spark, path, rows.schema, multi_line=True)


@query("select o_orderkey, o_orderpriority, o_totalprice from orders")
def inbox_filter(source: Source) -> DataFrame:
    """Only the files an inbox load accepts are read; drafts, locks and other types hold wrong prices."""
    root = scratch_path(source.spark, "inbox")
    rows = source.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    wrong = rows.withColumn("o_totalprice", F.lit(-1.0))
    files = Files(source.spark, root)
    for frame, name in ((rows, "sales-{}.CSV"), (wrong, "~sales-{}.csv"), (wrong, "+sales-{}.csv"), (wrong, "sales-{}.txt")):
        written = f"{root}/{name[0]}written"
        frame.write.mode("overwrite").csv(written)
        parts = [part for part, _ in files.children(written) if part.startswith("part-")]
        for number, part in enumerate(parts):
            files.move(f"{written}/{part}", f"{root}/inbox/{name.format(number)}")
    scanned = source.spark.read.schema(rows.schema).csv(f"{root}/inbox")
    return scanned.where(is_inbox_file(F.col("_metadata.file_name"), [".csv"]))


@query("select c_custkey, c_name, c_acctbal * 2 as c_acctbal from customer")
def latest_snapshot(source: Source) -> DataFrame:
    """The first allowed entry of the newest drop, as asked for; older drops and other entries are ignored."""
    root = scratch_path(source.spark, "drops")
    rows = source.customer.select("c_custkey", "c_name", "c_acctbal")
    drops = ((1, FIRST, "a.csv"), (2, SECOND, "a.CSV"), (3, SECOND, "b.csv"), (4, THIRD, "notes.txt"))
    for factor, day, entry in drops:
        drop = rows.withColumn("c_acctbal", F.col("c_acctbal") * factor)
        drop.write.option("header", "true").csv(f"{raw_partition(root, day)}/{entry}")
    return read_csv(source.spark, latest_drop_path(source.spark, root, [".csv"], first_only=True), rows.schema)


@query("select strftime(cast(ts as date), '%Y-%m-%d') as folder, true as has_bytes from events group by 1")
def file_audit(source: Source) -> DataFrame:
    """Day folders that hold data, from the file listing alone."""
    root = scratch_path(source.spark, "listed")
    stage_by_day(restated_events(source, 1), root, "event_date")
    listing = file_listing(source.spark, root).withColumn("folder", F.regexp_extract("path", r"event_date=([^/]+)/", 1))
    return listing.groupBy("folder").agg((F.sum("length") > 0).alias("has_bytes"))
