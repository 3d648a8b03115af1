import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators.quality import GateError
from lakemart.plans.upkeep import maintain
from lakemart.sources.files import Files
from lakemart.sources.tables import BucketedTable, KeyMonths, PartitionedTable, SnapshotTable

DAY = dt.date(2024, 1, 10)
FRAME = "data date, id string, m double"
GRAIN = ["data", "id"]


def day(n):
    return DAY + dt.timedelta(days=n)


def frame(spark, *items):
    return spark.createDataFrame([(day(n), ident, m) for n, ident, m in items], FRAME)


def content(table, rows):
    return rows(table.read(), "data", "id", "m")


def expected(*items):
    return sorted(((day(n), ident, m) for n, ident, m in items), key=repr)


def test_snapshot_versions_schema_change_and_time_travel(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.versions() == []
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.overwrite(spark.createDataFrame([(1, "a")], "`Cod. de Barras` int, `CPF/CNPJ` string")) == 0
    assert table.overwrite(spark.sql("select 2 as other, null as nothing")) == 1
    assert dict(table.read().dtypes) == {"other": "int", "nothing": "string"}
    assert rows(table.read(0)) == [(1, "a")]
    assert rows(table.read_as_of(table.versions()[0][1])) == [(1, "a")]
    with pytest.raises(FileNotFoundError):
        table.read_as_of(dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc))


def test_an_unfinished_version_is_not_read_and_is_written_again(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    spark.range(99).write.parquet(str(tmp_path / "t" / "v=1"))
    (tmp_path / "t" / "v=1" / "_SUCCESS").unlink()
    assert table.read().count() == 3
    assert table.overwrite(spark.range(5)) == 1
    assert table.read().count() == 5


def test_a_failed_load_leaves_the_table_as_it_was(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    with pytest.raises(Exception, match="broken"):
        table.overwrite(spark.range(3).withColumn("x", F.when(F.col("id") == 2, F.raise_error(F.lit("broken")))))
    assert table.read().count() == 3 and len(table.versions()) == 1


def test_snapshot_expiry_and_compaction(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for _ in range(3):
        table.overwrite(spark.range(100).repartition(8))
    now = dt.datetime.now(dt.timezone.utc)
    assert table.expire(168, now) == []
    assert table.expire(168, now + dt.timedelta(hours=200)) == [0, 1]
    assert table.compact() == 3
    assert table.read().count() == 100
    assert len([n for n, _ in Files(spark, str(tmp_path)).children(f"{table.path}/v=3") if n.startswith("part-")]) == 1
    assert table.compact() is None


def test_snapshot_merge(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.merge(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), ["k"])
    table.merge(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), ["k"])
    assert rows(table.read()) == [("a", 1), ("b", 2), ("c", 2)]


def test_partitioned_merge_touches_only_its_days(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    assert table.watermark() is None and table.window_start(10) == dt.date(1970, 1, 1)
    table.merge(frame(spark, (0, "a", 1.0), (1, "b", 1.0), (2, "c", 1.0)), GRAIN)
    first = tmp_path / "t" / "load=0"
    before = sorted((str(p), p.stat().st_mtime_ns) for p in first.rglob("*"))
    table.merge(frame(spark, (1, "b", 2.0), (1, "n", 2.0), (5, "d", 2.0)), GRAIN)
    assert content(table, rows) == expected((0, "a", 1.0), (1, "b", 2.0), (1, "n", 2.0), (2, "c", 1.0), (5, "d", 2.0))
    assert sorted((str(p), p.stat().st_mtime_ns) for p in first.rglob("*")) == before
    assert {p.name for p in (tmp_path / "t" / "load=1").glob("data=*")} == {f"data={day(1)}", f"data={day(5)}"}
    assert table.watermark() == day(5) and table.window_start(10) == day(-5)


def test_partitioned_window_prunes(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, (0, "a", 1.0), (9, "b", 1.0)), GRAIN)
    plan = table.window(day(5))._jdf.queryExecution().executedPlan().toString()
    assert f"data#" in plan and "PartitionFilters: [isnotnull(data" in plan
    monthly = PartitionedTable(spark, str(tmp_path / "m"), "data", by_month=True)
    monthly.merge(frame(spark, (0, "a", 1.0), (60, "b", 1.0)), ["id"])
    assert monthly.read().columns == ["data", "id", "m"]
    plan = monthly.window(day(50))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_month" in plan and "PushedFilters: [IsNotNull(data)" in plan
    assert monthly.watermark() == day(60)


def test_partitioned_reload_clears_days_the_source_lost(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, (0, "a", 1.0), (5, "b", 1.0), (6, "c", 1.0)), GRAIN)
    table.reload_window(frame(spark, (6, "c", 2.0)), day(5))
    assert content(table, rows) == expected((0, "a", 1.0), (6, "c", 2.0))


def test_monthly_reload_keeps_the_start_of_the_month(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data", by_month=True)
    table.merge(frame(spark, (0, "a", 1.0), (5, "b", 1.0), (40, "c", 1.0)), ["id"])
    table.reload_window(frame(spark, (7, "n", 2.0)), day(5))
    assert content(table, rows) == expected((0, "a", 1.0), (7, "n", 2.0))


def test_monthly_merge_moves_redated_rows(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data", by_month=True)
    table.merge(frame(spark, (0, "a", 1.0), (60, "b", 1.0), (90, "c", 1.0)), ["id"])
    table.merge(frame(spark, (60, "a", 2.0), (61, "b", 2.0)), ["id"])
    assert content(table, rows) == expected((60, "a", 2.0), (61, "b", 2.0), (90, "c", 1.0))
    assert sorted(table._partitions()) == [202403, 202404]


def test_null_days_have_their_own_partition(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, (0, "a", 1.0)), GRAIN)
    table.merge(spark.createDataFrame([(None, "x", 1.0)], FRAME), GRAIN)
    table.merge(spark.createDataFrame([(None, "x", 2.0)], FRAME), GRAIN)
    assert len(content(table, rows)) == 3 and table.watermark() == day(0)


def test_a_load_renames_nothing_and_a_failed_one_is_not_read(spark, rows, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, (0, "a", 1.0), (5, "b", 1.0), (6, "c", 1.0)), GRAIN)
    monkeypatch.setattr(Files, "move", None)
    with pytest.raises(Exception, match="broken"):
        broken = frame(spark, (5, "b", 2.0)).withColumn("m", F.when(F.col("id") == "b", F.raise_error(F.lit("broken"))).cast("double"))
        table._publish(broken.withColumn("m", F.col("m")), [day(5)])
    assert content(table, rows) == expected((0, "a", 1.0), (5, "b", 1.0), (6, "c", 1.0))
    table.reload_window(frame(spark, (5, "b", 2.0), (7, "d", 2.0)), day(5))
    assert content(table, rows) == expected((0, "a", 1.0), (5, "b", 2.0), (7, "d", 2.0))


def test_empty_sources_create_nothing_and_change_nothing(spark, rows, tmp_path):
    table, snapshot = PartitionedTable(spark, str(tmp_path / "t"), "data"), SnapshotTable(spark, str(tmp_path / "s"))
    none = frame(spark, (0, "a", 1.0)).limit(0)
    for _ in range(2):
        table.merge(none, GRAIN)
        table.reload_window(none, day(0))
        snapshot.merge(none, GRAIN)
        assert not table.exists() and not snapshot.exists()
    for item in (0, 1):
        table.merge(frame(spark, (item, "a", 1.0)), GRAIN)
    table.merge(none, GRAIN)
    assert content(table, rows) == expected((0, "a", 1.0), (1, "a", 1.0))
    # Clearing everything leaves a table without rows that can still be read and loaded.
    table.reload_window(none, day(0))
    assert table.exists() and table.read().count() == 0 and table.watermark() is None
    table.merge(frame(spark, (3, "z", 1.0)), GRAIN)
    assert content(table, rows) == expected((3, "z", 1.0))


def test_a_load_takes_the_types_of_the_table(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(spark.createDataFrame([(DAY, "a", 1)], "data date, id string, m bigint"), GRAIN)
    table.reload_window(spark.createDataFrame([(DAY, "b", 2.0)], FRAME), DAY)
    table.merge(spark.createDataFrame([(day(1), "c", 3.0)], FRAME), GRAIN)
    assert content(table, rows) == expected((0, "b", 2), (1, "c", 3)) and dict(table.read().dtypes)["m"] == "bigint"
    with pytest.raises(ValueError, match="unknown to the target"):
        table.reload_window(frame(spark, (0, "a", 1.0)).withColumn("extra", F.lit(1)), DAY)


def test_keys_that_a_source_holds_twice_are_refused(spark, rows, tmp_path):
    table, snapshot = PartitionedTable(spark, str(tmp_path / "t"), "data"), SnapshotTable(spark, str(tmp_path / "s"))
    twice = frame(spark, (0, "a", 1.0), (0, "a", 2.0), (1, "b", 1.0))
    for merge in (table.merge, snapshot.merge):
        with pytest.raises(GateError, match="several rows"):
            merge(twice, GRAIN)
    assert not table.exists() and not snapshot.exists()
    table.merge(spark.createDataFrame([(None, "x", 1.0), (None, "x", 2.0)], FRAME), GRAIN)
    assert table.read().count() == 2


def test_past_states_and_expiry_of_a_partitioned_table(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, (0, "a", 1.0), (1, "b", 1.0)), GRAIN)
    table.reload_window(frame(spark, (2, "c", 2.0)), day(1))
    table.merge(frame(spark, (0, "a", 3.0)), GRAIN)
    moments = [committed for _, committed in table.loads()]
    assert rows(table.read_as_of(moments[0]), "data", "id", "m") == expected((0, "a", 1.0), (1, "b", 1.0))
    assert rows(table.read_as_of(moments[1]), "data", "id", "m") == expected((0, "a", 1.0), (2, "c", 2.0))
    now = dt.datetime.now(dt.timezone.utc)
    assert table.expire(168, now) == []
    assert table.expire(168, now + dt.timedelta(hours=200)) == ["load=0"]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["load=1", "load=2", "maps"] and len(table.loads()) == 1
    assert content(table, rows) == expected((0, "a", 3.0), (2, "c", 2.0))
    assert table.expire(0, now + dt.timedelta(hours=200)) == []


def test_incremental_days_equal_one_full_load(spark, rows, tmp_path):
    items = [(n % 6, f"k{n % 4}", float(n)) for n in range(24)]
    final = {(n, ident): (n, ident, m) for n, ident, m in items}
    whole = PartitionedTable(spark, str(tmp_path / "whole"), "data")
    whole.merge(frame(spark, *final.values()), GRAIN)
    daily = PartitionedTable(spark, str(tmp_path / "daily"), "data")
    for batch in range(0, 24, 6):
        daily.merge(frame(spark, *{i[:2]: i for i in items[batch:batch + 6]}.values()), GRAIN)
    assert content(daily, rows) == content(whole, rows) == expected(*final.values())


def test_maintenance_skips_missing_tables_and_keeps_rows(spark, rows, tmp_path):
    daily = PartitionedTable(spark, str(tmp_path / "t"), "data")
    daily._publish(frame(spark, (0, "a", 1.0), (0, "b", 1.0), (0, "c", 1.0)), [DAY])
    folder = tmp_path / "t" / "load=0" / f"data={DAY}"
    for _ in range(2):
        frame(spark, (0, "d", 1.0)).drop("data").write.mode("append").parquet(str(folder))
    assert len(list(folder.glob("*.parquet"))) > 2
    assert maintain([daily, SnapshotTable(spark, str(tmp_path / "none"))]) == [daily.path]
    assert len(list((tmp_path / "t" / "load=1" / f"data={DAY}").glob("*.parquet"))) == 1
    assert content(daily, rows) == expected((0, "a", 1.0), (0, "b", 1.0), (0, "c", 1.0), (0, "d", 1.0), (0, "d", 1.0))


def jobs_of(spark, action):
    """Spark jobs that ``action`` starts."""
    tracker = spark.sparkContext._jsc.sc().statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    before = len(tracker.getJobIdsForGroup("counted"))
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return len(tracker.getJobIdsForGroup("counted")) - before


def test_a_read_after_many_loads_looks_at_one_map(spark, rows, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, *[(n, "a", 0.0) for n in range(20)]), GRAIN)
    # 200 loads that each restate one day, as far as maps and folders go.
    state = table._map(0)
    for number in range(1, 201):
        folder = f"data={day(number % 20)}"
        target = tmp_path / "t" / f"load={number}" / folder
        target.mkdir(parents=True)
        source = tmp_path / "t" / "load=0" / folder
        for file in source.glob("*.parquet"):
            (target / file.name).write_bytes(file.read_bytes())
        state["held"][folder] = number
        table.files.put(f"{table.path}/maps/{number}", __import__("json").dumps(state))
    texts, text = [], Files.text
    monkeypatch.setattr(Files, "text", lambda self, path: texts.append(path) or text(self, path))
    assert jobs_of(spark, table.read) == 0 and len(texts) == 1
    assert jobs_of(spark, lambda: table.window(day(15))) == 0
    assert len(table.loads()) == 201 and table.read().count() == 20
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert len(table.expire(0, later)) == 181 and len(list((tmp_path / "t").glob("load=*"))) == 20
    assert table.read().count() == 20 and len(table.loads()) == 1


def spoil(*folders):
    """Make every data file below the folders unreadable."""
    for folder in folders:
        for file in folder.rglob("*.parquet"):
            file.write_bytes(b"not parquet")


def test_a_merge_reads_the_months_of_its_keys_alone(spark, rows, tmp_path):
    months = KeyMonths(spark, str(tmp_path / "m"), ["id"], bucket_rows=1)
    table = PartitionedTable(spark, str(tmp_path / "t"), "data", by_month=True, index=months)

    def load(*items):
        source = frame(spark, *items)
        months.learn(source, table.month(F.col("data")))
        table.merge(source, ["id"])

    load(*[(40 * n, f"k{n}", 1.0) for n in range(8)])
    assert months._newest()[1]["buckets"] == 8
    moved = frame(spark, (200, "k1", 2.0))
    touched = {row[0] for row in moved.select(months._bucket(8)).collect()}
    held = table._newest()[1]["held"]
    spoil(*[p for p in (tmp_path / "m" / "load=0").glob("key_bucket=*") if int(p.name.split("=")[1]) not in touched])
    kept_months = {f"partition_month={table_month}" for table_month in (202402, 202407)}
    spoil(*[tmp_path / "t" / "load=0" / name for name in held if name not in kept_months])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "load=0").rglob("*")}
    load((200, "k1", 2.0))
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "load=0").rglob("*")} == before
    # Its old month is empty now; the others were neither read nor written.
    assert set(held) - set(table._newest()[1]["held"]) == {"partition_month=202402"}
    assert rows(table._in([202407]).where("id = 'k1'"), "data", "id", "m") == expected((200, "k1", 2.0))


def test_a_load_that_failed_after_its_keys_were_learnt_is_made_good(spark, rows, tmp_path):
    months = KeyMonths(spark, str(tmp_path / "m"), ["id"])
    table = PartitionedTable(spark, str(tmp_path / "t"), "data", by_month=True, index=months)
    for learnt, loaded in (([(0, "a", 1.0), (0, "b", 1.0)], True), ([(40, "a", 2.0)], False), ([(80, "a", 3.0)], False), ([(120, "a", 4.0)], True)):
        months.learn(frame(spark, *learnt), table.month(F.col("data")))
        if loaded:
            table.merge(frame(spark, *learnt), ["id"])
    assert content(table, rows) == expected((0, "b", 1.0), (120, "a", 4.0))


def test_a_bucketed_table_rewrites_the_buckets_of_its_keys(spark, rows, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], bucket_rows=10)
    table.merge(spark.range(100).selectExpr("id as k", "0 as v", "cast(null as string) as w"))
    assert table._newest()[1]["buckets"] == 10
    first = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "load=0").rglob("*")}
    # The key as another type is in the same bucket; an attribute the source does not know stays.
    table.merge(spark.createDataFrame([(7, 1, "x"), (300, 2, None)], "k int, v int, w string"), keep_where_null=["w"])
    table.merge(spark.createDataFrame([(7, 3, None)], "k int, v int, w string"), keep_where_null=["w"])
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "load=0").rglob("*")} == first
    assert len(list((tmp_path / "t" / "load=2").glob("key_bucket=*"))) == 1
    assert rows(table.read().where("v > 0")) == [(300, 2, None), (7, 3, "x")] and table.read().count() == 101
    with pytest.raises(ValueError, match="kept by"):
        table.merge(spark.range(1).selectExpr("id as k", "0 as v"), ["v"])
    with pytest.raises(GateError, match="several rows"):
        table.merge(spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, v int, w string"))


def test_the_number_of_buckets_is_bounded(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr("lakemart.sources.tables.MOST_BUCKETS", 8)
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], bucket_rows=1)
    for value in (0, 1):
        table.merge(spark.range(100).selectExpr("id as k", f"{value} as v"))
    table.compact()
    assert table._newest()[1]["buckets"] == 8 and len(table._newest()[1]["held"]) == 8
    assert rows(table.read()) == sorted([(n, 1) for n in range(100)], key=repr)


def test_buckets_are_doubled_once_they_have_grown(spark, rows, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], bucket_rows=10)
    for at in (0, 10, 20, 30, 40):
        table.merge(spark.range(at, at + 10).selectExpr("id as k", "0 as v"))
    assert table._newest()[1]["buckets"] == 1 and table.compact() == 4
    assert table._newest()[1]["buckets"] == 4 and table.read().count() == 50
    table.merge(spark.range(60).selectExpr("id as k", "1 as v"))
    assert table.read().count() == 60 and table.read().where("v = 0").count() == 0


def test_a_batch_taken_in_adds_no_load(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    for batch in (("s", 0), ("s", 1), ("s", 1), ("other", 0), ("s", 0), None):
        table.merge(frame(spark, (0, "a", 1.0)), GRAIN, batch=batch)
    assert len(table.loads()) == 4 and table._newest()[1]["batches"] == {"s": 1, "other": 0}


def test_a_map_cut_off_by_a_failure_is_written_again(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    table.merge(frame(spark, (0, "a", 1.0)), GRAIN)
    (tmp_path / "t" / "maps" / "1").write_text('{"held": {"data=2024')
    assert content(table, rows) == expected((0, "a", 1.0)) and len(table.loads()) == 1
    table.merge(frame(spark, (0, "a", 2.0)), GRAIN)
    assert content(table, rows) == expected((0, "a", 2.0)) and len(table.loads()) == 2


def test_a_first_load_that_is_laid_out_is_written_as_it_lies(spark, rows, tmp_path):
    first, second = (PartitionedTable(spark, str(tmp_path / name), "data", by_month=True) for name in "ab")
    first.merge(frame(spark, *[(n, f"k{n}", 1.0) for n in range(90)]), ["id"])
    spread, publish = [], second._publish
    second._publish = lambda *a, **b: spread.append(b["rebalance"]) or publish(*a, **b)
    for _ in range(2):
        second.merge(first.read(), ["id"], computed=False, laid_out=True)
    assert spread == [False, True] and rows(second.read()) == rows(first.read())
    files = lambda table: len([*(tmp_path / table / "load=0").rglob("*.parquet")])
    assert files("b") == files("a")
