import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakemart.functions.nested import flatten_variant
from lakemart.operators.upkeep import clustered, interleaved
from lakemart.sources.colocated import colocated, colocated_join
from lakemart.sources.tables import SnapshotTable, footer_statistics
from lakemart.streaming import arrivals as streams
from lakemart.sources.tables import PartitionedTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def row_groups_with(folder, column, value):
    """(row groups whose statistics admit the value, all row groups)"""
    admitted, every = 0, 0
    for file in folder.glob("*.parquet"):
        metadata = pq.ParquetFile(file).metadata
        place = metadata.schema.names.index(column)
        for i in range(metadata.num_row_groups):
            statistics = metadata.row_group(i).column(place).statistics
            every += 1
            admitted += statistics.min <= value <= statistics.max
    return admitted, every


def test_interleaved_bits(spark, rows):
    frame = spark.createDataFrame([(0b101, 0b011), (0, 0), (7, 7)], "a int, b int")
    assert rows(frame.select(interleaved([F.col("a"), F.col("b")], 3))) == [(0,), (0b100111,), (63,)]


def test_clustered_files_let_either_key_skip_row_groups(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    # A third of all rows has one key.
    frame = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"), F.col("id").alias("v"))
    table.overwrite(frame.repartition(16))
    table.cluster(["a", "b"], target_bytes=table.files.size(table._folder(0)) // 15)
    assert sorted(table.read().collect()) == sorted(table.read(0).collect())
    for column in "ab":
        before, all_before = row_groups_with(tmp_path / "t" / "v=0", column, 123)
        after, all_after = row_groups_with(tmp_path / "t" / "v=1", column, 123)
        assert before == all_before >= 16 and all_after >= 12 and after <= all_after / 2


def test_nulls_and_one_value_are_clustered_too(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, None), (5, 1.0)] * 5, "a int, b double")
    assert clustered(frame, ["a", "b"], 3).count() == 15
    assert clustered(frame.limit(0), ["a", "b"], 3).count() == 0


def test_colocated_tables_join_where_they_lie(spark, rows):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k"), F.col("id").alias("v"))
        dimension = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
        joined = colocated_join(colocated(fact, "k", 4), colocated(dimension, "k", 4), "k")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert rows(joined) == rows(fact.join(dimension, "k", "left").select("k", "v", "name"))
        table = colocated(dimension, "k", 4, name="colocated_again")
        assert colocated(dimension.limit(5), "k", 4, name="colocated_again").count() == 5 and table is not None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("drop table if exists colocated_again")


def test_footers_answer_without_reading_rows(spark, tmp_path):
    spark.range(100).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("day")).repartition(3).write.parquet(str(tmp_path / "t"))
    found = footer_statistics(spark, str(tmp_path / "t"), ["id", "day"])
    assert tuple(found.first()) == (100, 0, 99, dt.date(2024, 1, 1), dt.date(2024, 4, 9))
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(day), MAX(day)]" in plan_of(found)
    # The caller's session reads as before.
    assert "BatchScan" not in plan_of(spark.read.parquet(str(tmp_path / "t")))


def test_open_records(spark, rows):
    lines = [
        '{"id": 1, "a": {"b": 1, "c": [1, "x"]}, "mixed": 1}',
        '{"id": 2.5, "a": {"b": null}, "a_b": "top", "mixed": "one", "A_c": true, "nothing": null}',
        '{}',
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "line string").select(F.parse_json("line").alias("record"))
    flat = flatten_variant(frame, "record")
    assert sorted(flat.columns) == ["A_c", "a_b", "a_b_2", "a_c_2", "id", "mixed", "nothing"]
    got = {tuple(str(row[name]) for name in ("id", "mixed")): row for row in flat.collect()}
    assert [float(row["id"]) for row in flat.where("id is not null").orderBy("id").collect()] == [1.0, 2.5]
    by_mixed = {row["mixed"]: row for row in flat.collect()}
    assert set(by_mixed) == {"1", '"one"', None} and by_mixed["1"]["a_c_2"] == '[1,"x"]' and by_mixed['"one"']["A_c"] is True
    assert {by_mixed["1"]["a_b"], by_mixed["1"]["a_b_2"]} == {1, None} and len(got) == 3
    with pytest.raises(ValueError, match="no objects"):
        flatten_variant(spark.createDataFrame([("[1]",)], "line string").select(F.parse_json("line").alias("r")), "r")


def test_keyed_state_keeps_the_last_and_lets_old_days_go(spark, rows, tmp_path):
    schema = "ts timestamp, k string, n int"
    inbox, table = str(tmp_path / "inbox"), PartitionedTable(spark, str(tmp_path / "t"), "day")
    stream = streams.arrivals(spark, inbox, schema, "json")

    def take(*items):
        batch = [(dt.datetime(2024, 1, day, hour), key, n) for day, hour, key, n in items]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(inbox)
        streams.keep_latest_available(stream, table, "ts", ["k"], ["ts", "n"], "3 days", str(tmp_path / "checkpoint"))

    take((1, 5, "a", 1), (1, 7, "a", 2), (1, 7, "a", 1), (2, 1, "b", 1))
    # An earlier record of a day that is still open loses, a later one wins.
    take((1, 6, "a", 9), (2, 2, "b", 2), (9, 1, "c", 1))
    # January 9 minus three days: the first two days are closed by now.
    take((1, 23, "a", 99), (6, 1, "d", 1), (9, 0, "c", 7))
    assert rows(table.read(), "day", "k", "n") == [
        (dt.date(2024, 1, 1), "a", 2), (dt.date(2024, 1, 2), "b", 2), (dt.date(2024, 1, 6), "d", 1), (dt.date(2024, 1, 9), "c", 1)]
