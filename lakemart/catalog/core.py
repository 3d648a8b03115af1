"""Watermarks, deduplication, write strategies and quality gates as plain frames."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakemart import spec
from lakemart.catalog.frames import order_day, SOURCE_FROM, TARGET_UNTIL, daily_events
from lakemart.catalog.registry import Source, query
from lakemart.operators.dedup import distinct_rows, keep_last as last_per_grain
from lakemart.operators.projection import select_present as present_columns
from lakemart.operators.quality import (
    all_present, any_positive as active_rows, duplicate_keys, exclude_ids as without_ids,
    missing_key_report as missing_keys, row_counts, snapshot_report, split_rejects,
)
from lakemart.operators.upkeep import compaction_plan as plan_compaction, expired_versions as old_versions
from lakemart.operators.upsert import merge_rows, reload_rows, scd1
from lakemart.operators.windows import (
    date_slices as slices, high_watermark as watermark, load_window as extraction_window, scan_window, slice_number,
    window_start as first_day, window_start_column,
)

GRAIN = ["data", "user_id"]
DAILY_SQL = """
    select cast(ts as date) as data, user_id, event_id, event_type, value from events
    qualify row_number() over (
        partition by cast(ts as date), user_id order by ts desc, event_id desc) = 1
"""


def daily_last(source: Source) -> DataFrame:
    events = daily_events(source).drop("props")
    return last_per_grain(events, GRAIN, ["ts", "event_id"]).select("data", "user_id", "event_id", "event_type", "value")


def target_and_restated(source: Source) -> tuple[DataFrame, DataFrame]:
    """Rows loaded so far, and the overlapping later window with doubled values."""
    last = daily_last(source)
    restated = last.where(F.col("data") >= F.lit(SOURCE_FROM)).withColumn("value", F.col("value") * 2)
    return last.where(F.col("data") <= F.lit(TARGET_UNTIL)), restated


TARGET_AND_RESTATED_SQL = f"""
    with last as ({DAILY_SQL}),
    t as (select * from last where data <= date '2024-01-20'),
    s as (select data, user_id, event_id, event_type, value * 2 as value from last
          where data >= date '2024-01-11')
"""


@query(DAILY_SQL)
def keep_last(source: Source) -> DataFrame:
    return daily_last(source)


@query("select max(cast(ts as date)) as watermark from events")
def high_watermark(source: Source) -> DataFrame:
    return watermark(daily_events(source), "data")


@query("""
    select 'first load' as target, date '1970-01-01' as window_start
    union all select 'loaded', max(cast(ts as date)) - 10 from events
""")
def window_start(source: Source) -> DataFrame:
    days = daily_events(source)
    start = window_start_column(F.col("watermark"), 10)
    loaded = watermark(days, "data").select(F.lit("loaded").alias("target"), start.alias("window_start"))
    nothing = watermark(days.where(F.col("data").isNull()), "data")
    return nothing.select(F.lit("first load").alias("target"), start.alias("window_start")).unionByName(loaded)


@query("""
    select event_id, user_id, cast(ts as date) as data, value from events
    where cast(ts as date) >= (select max(cast(ts as date)) - 10 from events)
""")
def window_scan(source: Source) -> DataFrame:
    """The bound is fetched first, so that as a literal it reaches the Parquet scan."""
    days = daily_events(source).select("event_id", "user_id", "data", "value")
    latest = watermark(days, "data").first()["watermark"]
    return scan_window(days, "data", first_day(latest, 10))


@query(TARGET_AND_RESTATED_SQL + """
    select * from s union all
    select * from t where not exists (select 1 from s where s.data = t.data and s.user_id = t.user_id)
""")
def merge_upsert(source: Source) -> DataFrame:
    target, restated = target_and_restated(source)
    return merge_rows(target, restated, GRAIN)


@query(TARGET_AND_RESTATED_SQL + """
    select s.data, s.user_id, s.event_id, t.event_type, s.value from s left join t using (data, user_id)
    union all
    select * from t where not exists (select 1 from s where s.data = t.data and s.user_id = t.user_id)
""")
def merge_partial_columns(source: Source) -> DataFrame:
    """The source lacks a column: matched rows keep the target's value."""
    target, restated = target_and_restated(source)
    return merge_rows(target, restated.drop("event_type"), GRAIN)


@query(TARGET_AND_RESTATED_SQL + """
    select * from s where event_type <> 'error' union all
    select * from t where data < date '2024-01-11'
""")
def window_reload(source: Source) -> DataFrame:
    """Keys missing from the reloaded window disappear from it."""
    target, restated = target_and_restated(source)
    return reload_rows(target, restated.where("event_type <> 'error'"), "data", SOURCE_FROM)


@query("""
    select o_custkey, o_orderstatus, o_orderpriority from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1
""")
def scd1_dims(source: Source) -> DataFrame:
    key, columns, order = ["o_custkey"], ["o_custkey", "o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    split = F.lit(dt.date(1998, 7, 1))
    older = scd1(None, source.orders.where(order_day() < split), key, columns, order)
    return scd1(older, source.orders.where(order_day() >= split), key, columns, order)


@query("""
    select o_orderkey, case when o_orderstatus = 'P' then 'F' else o_orderstatus end as status,
           case when o_orderstatus = 'P' then 2 else 1 end as arrival
    from orders where o_orderpriority <> '5-LOW'
""")
def latest_by_key(source: Source) -> DataFrame:
    """Orders arriving twice with another status; those without a key or day are dropped."""
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("o_orderkey")
    first = source.orders.select(key, F.col("o_orderstatus").alias("status"), F.lit(1).alias("arrival"))
    second = first.where("status = 'P'").withColumns({"status": F.lit("F"), "arrival": F.lit(2)})
    return last_per_grain(all_present(first.unionByName(second), ["o_orderkey"]), ["o_orderkey"], ["arrival"])


@query("select distinct c_mktsegment, c_nationkey from customer")
def distinct_dims(source: Source) -> DataFrame:
    return distinct_rows(source.customer, ["c_mktsegment", "no_such_column", "c_nationkey"])


@query("""
    with m as (select max(cast(ts as date)) as top from events),
    bounds as (
        select 'ads, later load' as load, top - 10 as first, date '2024-03-01' as last, 14 as days from m
        union all select 'ads, first load', date '2024-03-01' - 90, date '2024-03-01', 14
        union all select 'sales, later load', top - 90, date '2024-03-01', 90 from m
        union all select 'sales, first load', date '2024-03-01' - 1825, date '2024-03-01', 90
        union all select 'asked for', date '2023-12-30', date '2024-01-02', 14)
    select load, (first + s * days::integer)::date as slice_start, least(first + s * days::integer + days::integer - 1, last)::date as slice_end
    from (select *, unnest(generate_series(0, date_diff('day', first, last) // days))::integer as s from bounds)
""")
def load_window(source: Source) -> DataFrame:
    """The days each kind of load extracts, cut into the slices of its requests."""
    day, top = dt.date(2024, 3, 1), watermark(daily_events(source), "data").first()[0]
    ads, sales = (spec.ADS_LOOKBACK_DAYS, spec.ADS_BACKFILL_DAYS), (spec.SALES_LOOKBACK_DAYS, spec.SALES_BACKFILL_DAYS)
    asked = (dt.date(2023, 12, 30), dt.date(2024, 1, 2))
    bounds = [
        ("ads, later load", *extraction_window(top, *ads, day), spec.ADS_SLICE_DAYS),
        ("ads, first load", *extraction_window(None, *ads, day), spec.ADS_SLICE_DAYS),
        ("sales, later load", *extraction_window(top, *sales, day), spec.SALES_SLICE_DAYS),
        ("sales, first load", *extraction_window(None, *sales, day), spec.SALES_SLICE_DAYS),
        ("asked for", *extraction_window(top, *ads, day, asked), spec.ADS_SLICE_DAYS),
    ]
    tiles = [
        slices(source.spark.createDataFrame([(first, last)], "first date, last date"), "first", "last", days)
        .select(F.lit(load).alias("load"), "slice_start", "slice_end") for load, first, last, days in bounds
    ]
    return reduce(DataFrame.unionByName, tiles)


@query("""
    with b as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders),
    n as (select floor(date_diff('day', b.lo, cast(o_orderdate as date)) / 90) as slice, count(*) as orders
          from orders, b group by 1),
    g as (select unnest(generate_series(0, date_diff('day', lo, hi) // 90)) as slice, lo, hi from b)
    select lo + cast(g.slice * 90 as integer) as slice_start,
           least(lo + cast(g.slice * 90 + 89 as integer), hi) as slice_end, coalesce(n.orders, 0) as orders
    from g left join n on n.slice = g.slice
""")
def date_slices(source: Source) -> DataFrame:
    """90-day slices tiling the order days, with the number of orders in each."""
    days = source.orders.select(order_day().alias("day"))
    bounds = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    first = days.agg(F.min("day")).scalar()
    counts = days.groupBy(slice_number(F.col("day"), first, 90).alias("slice")).agg(F.count(F.lit(1)).alias("orders"))
    tiles = slices(bounds, "lo", "hi", 90).withColumn("slice", slice_number(F.col("slice_start"), first, 90))
    return tiles.join(counts, "slice", "left").select(
        "slice_start", "slice_end", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders")
    )


@query("select event_id, value from events")
def select_present(source: Source) -> DataFrame:
    return present_columns(source.events, ["event_id", "cost_per_unique_click", "value"])


@query("""
    select * from (select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment, nullif(c_nationkey, 3) as nation
                   from customer) where segment is not null and nation is not null
""")
def contact_filter(source: Source) -> DataFrame:
    contacts = source.customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
    )
    return all_present(contacts, ["segment", "nation"])


@query("select c_custkey, nullif(c_nationkey, 3) as nation from customer where nullif(c_nationkey, 3) not in (5, 7)")
def exclude_ids(source: Source) -> DataFrame:
    rows = source.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"))
    return without_ids(rows, "nation", [5, 7])


@query("""
    select o_orderkey, o_custkey from orders
    where o_custkey not in (select c_custkey from customer where c_acctbal < 0)
""")
def exclude_listed_rows(source: Source) -> DataFrame:
    blocked = source.customer.where("c_acctbal < 0").select("c_custkey")
    return without_ids(source.orders.select("o_orderkey", "o_custkey"), "o_custkey", blocked)


@query("""
    select event_id, spend, clicks from (
        select event_id, case event_type when 'error' then null when 'view' then 'NaN'
                         when 'signup' then cast(-value as varchar) else '0' end as spend,
               case when event_type = 'click' then value when event_type = 'purchase' then 0.5 end as clicks
        from events)
    where (try_cast(spend as double) > 0 and not isnan(try_cast(spend as double))) or clicks >= 1
""")
def any_positive(source: Source) -> DataFrame:
    kind = F.col("event_type")
    rows = source.events.select(
        "event_id",
        F.when(kind == "error", None).when(kind == "view", "NaN")
        .when(kind == "signup", (-F.col("value")).cast("string")).otherwise("0").alias("spend"),
        F.when(kind == "click", F.col("value")).when(kind == "purchase", 0.5).alias("clicks"),
    )
    return active_rows(rows, ["spend"], ["clicks"])


@query("""
    select cast(ts as date) as data, count(*) as missing from events
    where event_type = 'error' and value > 50 group by 1
""")
def missing_key_report(source: Source) -> DataFrame:
    lost = (F.col("event_type") == "error") & (F.col("value") > 50)
    return missing_keys(daily_events(source).withColumn("user_id", F.when(~lost, F.col("user_id"))), "data", "user_id")


@query("""
    select 'o_orderkey' as column_name, true as present, count(*) as row_count, count(o_orderkey) as value_count from orders
    union all select 'status', true, count(*), count(nullif(o_orderstatus, 'P')) from orders
    union all select 'no_such_column', false, count(*), 0 from orders
""")
def snapshot_gate(source: Source) -> DataFrame:
    snapshot = source.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return snapshot_report(snapshot, ["o_orderkey", "status", "no_such_column"])


@query("""
    select 'loaded' as part, event_id, user_id from events where event_type <> 'error'
    union all select 'rejected', event_id, null from events where event_type = 'error'
""")
def reject_split(source: Source) -> DataFrame:
    rows = source.events.select("event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    loaded, rejected = split_rejects(rows, ["event_id", "user_id"])
    return loaded.withColumn("part", F.lit("loaded")).unionByName(rejected.withColumn("part", F.lit("rejected")))


@query("""
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by all having count(*) > 1
""")
def duplicate_key_audit(source: Source) -> DataFrame:
    return duplicate_keys(source.lineitem, ["l_orderkey", "l_linenumber"])


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(" union all ".join(f"select '{name}' as table_name, count(*) as row_count from {name}" for name in TABLES))
def row_count_audit(source: Source) -> DataFrame:
    return row_counts({name: getattr(source, name) for name in TABLES})


@query("select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def top_sample(source: Source) -> DataFrame:
    """The serving layer's 50-row sample, ordered so that it is always the same."""
    return source.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("""
    select * from (
        select strftime(o_orderdate, '%Y-%m') as folder, count(*) as files,
               count(*) filter (o_totalprice < 150000) as small_files, cast(sum(cast(o_totalprice as bigint)) as bigint) as bytes,
               greatest(cast(ceil(sum(cast(o_totalprice as bigint)) / 400000) as bigint), 1) as files_after
        from (select o_orderdate, floor(o_totalprice) as o_totalprice from orders) group by 1)
    where small_files > 1 and files_after < files
""")
def compaction_plan(source: Source) -> DataFrame:
    """Orders as files: the month is the folder and the price the file size."""
    listing = source.orders.select(
        F.date_format(order_day(), "yyyy-MM").alias("folder"), F.floor("o_totalprice").alias("length")
    )
    return plan_compaction(listing, ["folder"], small_bytes=150_000, target_bytes=400_000)


@query("""
    with v as (select o_custkey as table_id, date_diff('day', date '1990-01-01', cast(o_orderdate as date)) as version,
                      cast(o_orderdate as date) as day from orders)
    select table_id, version, day from v where version < (
        select max(w.version) from v w where w.table_id = v.table_id and w.day <= date '2000-06-01' - 7)
""")
def expired_versions(source: Source) -> DataFrame:
    """Orders as commits: the customer is the table and the order day the version."""
    commits = source.orders.select(
        F.col("o_custkey").alias("table_id"),
        F.datediff(order_day(), F.lit(dt.date(1990, 1, 1))).cast("bigint").alias("version"),
        F.col("o_orderdate").alias("committed_at"), order_day().alias("day"),
    )
    now = F.lit("2000-06-01 00:00:00").cast("timestamp_ntz")
    return old_versions(commits, now, 168, by=["table_id"]).drop("committed_at")
