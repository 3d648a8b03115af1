"""The table layouts on disk: versions, partition rewrites and maintenance."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakemart.catalog.core import GRAIN, TARGET_AND_RESTATED_SQL, target_and_restated
from lakemart.catalog.frames import order_day, SOURCE_FROM
from lakemart.catalog.registry import Source, query
from lakemart.operators.upsert import dimension_rows
from lakemart.plans.upkeep import maintain
from lakemart.session import scratch_path
from lakemart.sources.tables import BucketedTable, KeyMonths, PartitionedTable, SnapshotTable, footer_statistics


def two_versions(source: Source) -> SnapshotTable:
    table = SnapshotTable(source.spark, scratch_path(source.spark, "snapshots"))
    rows = source.customer.select("c_custkey", "c_name", "c_acctbal")
    table.overwrite(rows.withColumn("c_acctbal", F.col("c_acctbal") * 2))
    table.overwrite(rows.withColumn("segment", F.lit("new column")).drop("c_name"))
    return table


@query("select c_custkey, c_acctbal, 'new column' as segment from customer")
def snapshot_overwrite(source: Source) -> DataFrame:
    return two_versions(source).read()


@query("select c_custkey, c_name, c_acctbal * 2 as c_acctbal from customer")
def snapshot_as_of(source: Source) -> DataFrame:
    table = two_versions(source)
    return table.read_as_of(table.versions()[0][1])


DAILY_COLUMNS = ["data", "user_id", "event_id", "event_type", "value"]


@query(TARGET_AND_RESTATED_SQL + """
    select * from s union all
    select * from t where not exists (select 1 from s where s.data = t.data and s.user_id = t.user_id)
""")
def partitioned_merge(source: Source) -> DataFrame:
    """Day-partitioned table, loaded and then merged with an overlapping restated window, twice."""
    target, restated = target_and_restated(source)
    table = PartitionedTable(source.spark, scratch_path(source.spark, "daily"), "data")
    for rows in (target, restated, restated):
        table.merge(rows, GRAIN)
    return table.read().select(*DAILY_COLUMNS)


@query(TARGET_AND_RESTATED_SQL + """
    select * from s where event_type <> 'error' and data <> date '2024-01-15' union all
    select * from t where data < date '2024-01-11'
""")
def partitioned_reload(source: Source) -> DataFrame:
    """Reloading a window also clears a day the source no longer has."""
    target, restated = target_and_restated(source)
    table = PartitionedTable(source.spark, scratch_path(source.spark, "reloaded"), "data")
    table.merge(target, GRAIN)
    kept = restated.where((F.col("event_type") != "error") & (F.col("data") != F.lit(dt.date(2024, 1, 15))))
    table.reload_window(kept, SOURCE_FROM)
    return table.read().select(*DAILY_COLUMNS)


@query(TARGET_AND_RESTATED_SQL + "select * from t")
def partitioned_as_of(source: Source) -> DataFrame:
    """A partitioned table as it was before its window was reloaded."""
    target, restated = target_and_restated(source)
    table = PartitionedTable(source.spark, scratch_path(source.spark, "past"), "data")
    table.merge(target, GRAIN)
    table.reload_window(restated, SOURCE_FROM)
    return table.read_as_of(table.loads()[0][1]).select(*DAILY_COLUMNS)


@query("""
    select o_orderkey, case when o_orderpriority = '1-URGENT' then 'moved' else o_orderstatus end as status,
           cast(o_orderdate as date) + case when o_orderpriority = '1-URGENT' then 45 else 0 end as data
    from orders
""")
def redated_merge(source: Source) -> DataFrame:
    """Month-partitioned table keyed without the day: re-dated orders leave their old month."""
    table = PartitionedTable(source.spark, scratch_path(source.spark, "monthly"), "data", by_month=True)
    orders = source.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), order_day().alias("data"), "o_orderpriority")
    table.merge(orders.drop("o_orderpriority"), ["o_orderkey"])
    moved = orders.where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", F.lit("moved").alias("status"), F.date_add("data", 45).alias("data")
    )
    table.merge(moved, ["o_orderkey"])
    return table.read()


@query("""
    select o_custkey, o_orderstatus, o_orderpriority from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1
""")
def dimension_table(source: Source) -> DataFrame:
    """A dimension merged year by year, every load reading the table the last one wrote."""
    table = SnapshotTable(source.spark, scratch_path(source.spark, "dimension"))
    key, columns, order = ["o_custkey"], ["o_custkey", "o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    for first, last in ((1900, 1996), (1997, 1998), (1999, 2100)):
        year = source.orders.where(F.year(order_day()).between(first, last))
        table.merge(dimension_rows(year, key, columns, order), key)
    return table.read()


@query("""
    select 'monthly' as table_name, count(*) as row_count, sum(o_orderkey)::bigint as keys,
           count(distinct strftime(o_orderdate, '%Y%m')) as files_after, true as fewer, 1::bigint as versions from orders
    union all select 'snapshot', count(*), sum(o_orderkey)::bigint, 1, true, 1 from orders
""")
def maintenance_job(source: Source) -> DataFrame:
    """Tables of many small files: the same rows afterwards, in one file per partition, expired versions gone."""
    spark = source.spark
    rows = source.orders.select("o_orderkey", order_day().alias("data"), "o_totalprice")
    root = scratch_path(spark, "upkeep")
    monthly = PartitionedTable(spark, f"{root}/monthly", "data", by_month=True)
    snapshot = SnapshotTable(spark, f"{root}/snapshot")
    # Every month is written in several files, as by a table that grew by many small appends.
    spread = monthly._with_partition(rows).repartition(3, F.pmod("o_orderkey", F.lit(3)))
    monthly._publish(spread, [], rebalance=False)
    for _ in range(2):
        snapshot.overwrite(rows.repartition(8))
    before = {table: table.read().inputFiles() for table in (monthly, snapshot)}
    maintain([monthly, snapshot, SnapshotTable(spark, f"{root}/missing")], retention_hours=0)
    found = []
    for name, table in (("monthly", monthly), ("snapshot", snapshot)):
        files, versions = table.read().inputFiles(), table.loads() if table is monthly else table.versions()
        found.append(table.read().agg(F.count("*").alias("row_count"), F.sum("o_orderkey").alias("keys")).select(
            F.lit(name).alias("table_name"), "row_count", "keys", F.lit(len(files)).cast("bigint").alias("files_after"),
            F.lit(len(files) < len(before[table])).alias("fewer"), F.lit(len(versions)).cast("bigint").alias("versions")))
    return found[0].unionByName(found[1])


@query("""
    select o_orderkey, case when o_orderkey % 5 = 0 then 'third' when o_orderpriority = '1-URGENT' then 'moved' else o_orderstatus end as status,
           cast(o_orderdate as date) + case when o_orderkey % 5 = 0 then 400 when o_orderpriority = '1-URGENT' then 45 else 0 end as data
    from orders
""")
def indexed_merge(source: Source) -> DataFrame:
    """Three loads of a month-partitioned table whose side table tells in which months a re-dated order may be."""
    months = KeyMonths(source.spark, scratch_path(source.spark, "order-months"), ["o_orderkey"], bucket_rows=2000)
    table = PartitionedTable(source.spark, scratch_path(source.spark, "indexed"), "data", by_month=True, index=months)
    orders = source.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), order_day().alias("data"), "o_orderpriority")
    moved = orders.where("o_orderpriority = '1-URGENT'").withColumn("status", F.lit("moved")).withColumn("data", F.date_add("data", 45))
    third = orders.where("o_orderkey % 5 = 0").withColumn("status", F.lit("third")).withColumn("data", F.date_add("data", 400))
    for load in (orders, moved, third):
        rows = load.drop("o_orderpriority")
        months.learn(rows, table.month(F.col("data")))
        table.merge(rows, ["o_orderkey"])
    return table.read()


@query("""
    select o_custkey, o_orderstatus, o_orderpriority from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1
""")
def bucketed_dimension(source: Source) -> DataFrame:
    """The dimension kept by the hash of its key: each year rewrites the buckets of its own customers."""
    key, columns, order = ["o_custkey"], ["o_custkey", "o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    table = BucketedTable(source.spark, scratch_path(source.spark, "bucketed"), key, bucket_rows=100)
    for first, last in ((1900, 1996), (1997, 1998), (1999, 2100)):
        year = source.orders.where(F.year(order_day()).between(first, last))
        table.merge(dimension_rows(year, key, columns, order))
    return table.read()


@query("""
    select l_orderkey, l_partkey, l_quantity, true as in_order from lineitem
""")
def clustered_compaction(source: Source) -> DataFrame:
    """A compaction that sorts by two keys at once keeps every row; its files each span a part of both keys."""
    table = SnapshotTable(source.spark, scratch_path(source.spark, "clustered"))
    table.overwrite(source.lineitem.select("l_orderkey", "l_partkey", "l_quantity"))
    size = table.files.size(table._folder(0))
    version = table.cluster(["l_orderkey", "l_partkey"], target_bytes=max(1, size // 16))
    rows = table.read(version)
    spans = rows.groupBy(F.input_file_name().alias("file")).agg(*[
        (F.max(name) - F.min(name)).alias(name) for name in ("l_orderkey", "l_partkey")])
    whole = rows.agg(*[(F.max(name) - F.min(name)).alias(name) for name in ("l_orderkey", "l_partkey")]).first()
    narrow = spans.agg(*[F.avg(F.col(name) / whole[name]).alias(name) for name in ("l_orderkey", "l_partkey")]).first()
    # Sixteen files in a square of four by four: each about a quarter of either key.
    return rows.withColumn("in_order", F.lit(max(narrow) < 0.6))


FOOTER_KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "lineitem": "l_orderkey", "events": "event_id", "part": "p_partkey"}


@query(" union all ".join(
    f"select '{table}' as table_name, count(*) as rows, min({key}) as low, max({key}) as high from {table}" for table, key in FOOTER_KEYS.items()))
def footer_audit(source: Source) -> DataFrame:
    """Counts and bounds of tables from file footers alone."""
    found = [footer_statistics(source.spark, f"{source.folder.rstrip('/')}/{table}.parquet", [key]).select(
        F.lit(table).alias("table_name"), "rows", F.col(f"low_{key}").alias("low"), F.col(f"high_{key}").alias("high"))
        for table, key in FOOTER_KEYS.items()]
    return reduce(DataFrame.unionByName, found)
