import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.catalog import REGISTRY
from lakemart.operators.dedup import keep_last
from lakemart.operators.lookups import star_join
from lakemart.operators.upsert import merge_rows
from lakemart.sources.landing import read_partition, stage_by_day
from lakemart.sources.tables import PartitionedTable

SF = "/root/testdata/sf0.001"
# Queries that only compute: their plan can be read without running a job that writes files.
PURE = [name for name, entry in REGISTRY.items() if entry.build.__closure__[0].cell_contents.__module__.endswith(("core", "columns", "joins"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = plan_of(REGISTRY[name].build(spark, SF))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_keep_last_aggregates_before_its_only_shuffle(spark):
    frame = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(keep_last(frame, ["user_id"], ["ts", "event_id"]))
    assert plan.count("Exchange") == 1
    assert plan.index("partial_max_by") > plan.index("Exchange")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keep_last_and_merge_read_each_side_once(spark, no_broadcast):
    frame = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "value")
    last = keep_last(frame, ["user_id"], ["ts", "value"])
    plan = plan_of(merge_rows(last, last.withColumn("value", F.col("value") * 2), ["user_id"]))
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan and plan.count("FileScan") == 2


@pytest.mark.parametrize("name", ["merge_upsert", "merge_partial_columns", "scd1_dims"])
def test_merges_read_the_source_once(spark, no_broadcast, name):
    plan = plan_of(REGISTRY[name].build(spark, SF))
    assert plan.count("FileScan") == 2 and "LeftAnti" not in plan


def test_a_star_join_reads_only_its_columns(spark, no_broadcast):
    fact = spark.read.parquet(f"{SF}/lineitem.parquet")
    part = spark.read.parquet(f"{SF}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    plan = plan_of(star_join(fact, [(part, ["l_partkey"])]).select("l_orderkey", "p_brand"))
    schemas = [line for line in plan.splitlines() if "l_orderkey" in line and "ReadSchema" in line]
    assert schemas and all("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in line for line in schemas)


def test_window_scan_reaches_the_parquet_reader(spark):
    plan = plan_of(REGISTRY["window_scan"].build(spark, SF))
    assert "GreaterThanOrEqual(ts," in plan and "props" not in plan


def test_a_table_window_reads_only_its_partitions(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("date").alias("data"), "event_id", "value")
    table.merge(events, ["data", "event_id"])
    read = table.window(dt.date(2024, 1, 25)).select("value")
    assert "PartitionFilters: [isnotnull(data" in plan_of(read) and "event_id" not in plan_of(read)


def test_landing_readers_read_only_their_columns(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value", F.col("ts").cast("date").alias("event_date"))
    stage_by_day(events, str(tmp_path / "ingestion_date=2024-02-01"), "event_date", "parquet")
    plan = plan_of(read_partition(spark, str(tmp_path), dt.date(2024, 2, 1), "event_id bigint, value double", "parquet").select("value"))
    assert "ReadSchema: struct<value:double" in plan and "event_id" not in plan
