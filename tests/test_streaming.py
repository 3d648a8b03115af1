import datetime as dt

import pytest
from pyspark.sql import types as T

from lakemart.sources.tables import PartitionedTable
from lakemart.streaming import arrivals as streams

SCHEMA = T.StructType([
    T.StructField("data", T.DateType()), T.StructField("id", T.StringType()),
    T.StructField("o", T.LongType()), T.StructField("m", T.DoubleType()),
])
DAY = dt.date(2024, 1, 20)


def land(spark, path, *items):
    rows = [(None if n is None else DAY + dt.timedelta(days=n), i, o, m) for n, i, o, m in items]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def test_no_new_files_means_no_batch(spark, tmp_path):
    inbox, seen = str(tmp_path / "inbox"), []
    stream = streams.arrivals(spark, inbox, SCHEMA, "json")
    for expected in ([], [2], [2], [2, 1]):
        if len(expected) > len(seen) or (expected == [2] and not seen):
            land(spark, inbox, *[(0, "a", 1, 1.0)] * expected[-1])
        streams.load_available(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "checkpoint"))
        assert seen == expected


def test_waiting_for_an_arrival_gives_up(spark, tmp_path):
    inbox, seen = str(tmp_path / "inbox"), []
    stream = streams.arrivals(spark, inbox, SCHEMA, "json")

    def wait():
        return streams.load_when_arrived(
            stream, lambda df, n: seen.append(df.count()), str(tmp_path / "checkpoint"), 0.1, 0.3
        )

    assert not wait()
    land(spark, inbox, (0, "a", 1, 1.0))
    assert wait() and seen == [1]
    assert not wait()


def test_upsert_is_idempotent_and_ignores_late_rows(spark, rows, tmp_path):
    inbox = str(tmp_path / "inbox")
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    stream = streams.arrivals(spark, inbox, SCHEMA, "json")

    def run(checkpoint):
        streams.upsert_available(stream, table, ["data", "id"], ["o"], str(tmp_path / checkpoint), lookback_days=10)

    land(spark, inbox, (0, "a", 1, 1.0), (0, "a", 2, 2.0), (-3, "b", 1, 3.0), (None, "lost", 1, 0.0), (1, None, 1, 0.0))
    run("c1")
    first = rows(table.read(), "data", "id", "m")
    assert [row[1:] for row in first] == [("b", 3.0), ("a", 2.0)]
    run("c2")  # the same files again, as after a lost checkpoint
    assert rows(table.read(), "data", "id", "m") == first
    land(spark, inbox, (-3, "b", 1, 9.0), (-11, "too late", 1, 9.0), (-10, "just in time", 1, 9.0))
    run("c1")
    assert sorted(row[1:] for row in rows(table.read(), "data", "id", "m")) == [("a", 2.0), ("b", 9.0), ("just in time", 9.0)]


def test_archive_moves_files_one_batch_late(spark, tmp_path):
    inbox, archive = tmp_path / "inbox", tmp_path / "archive"
    archive.mkdir()
    stream = streams.arrivals(spark, str(inbox), SCHEMA, "json", archive=str(archive))
    for n in range(3):
        land(spark, str(inbox), (0, f"k{n}", 1, 1.0))
        streams.load_available(stream, lambda df, batch: df.count(), str(tmp_path / "checkpoint"))
    assert len(list(archive.rglob("part-*.json"))) in (1, 2)
    assert len(list(inbox.rglob("part-*.json"))) >= 1


def test_a_failing_batch_is_taken_again(spark, rows, tmp_path):
    inbox = str(tmp_path / "inbox")
    stream = streams.arrivals(spark, inbox, SCHEMA, "json")
    land(spark, inbox, (0, "a", 1, 1.0))

    def fail(batch, n):
        raise RuntimeError("lost executor")

    with pytest.raises(Exception, match="lost executor"):
        streams.load_available(stream, fail, str(tmp_path / "checkpoint"))
    table = PartitionedTable(spark, str(tmp_path / "t"), "data")
    streams.upsert_available(stream, table, ["data", "id"], ["o"], str(tmp_path / "checkpoint"))
    assert rows(table.read(), "id", "m") == [("a", 1.0)]
