import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakemart.operators import dedup, lookups, quality, upkeep, upsert, windows

DAY = dt.date(2024, 1, 10)
FRAME = "data date, id string, m double"


def day(n):
    return DAY + dt.timedelta(days=n)


def test_keep_last_prefers_the_greatest_order_and_keeps_null_groups(spark, rows):
    frame = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), ("b", None, "only"), (None, 1, "x"), (None, 3, "y"), ("c", None, "n"), ("c", 0, "z")],
        "k string, o int, v string",
    )
    assert rows(dedup.keep_last(frame, ["k"], ["o"])) == sorted(
        [("a", 2, "new"), ("b", None, "only"), (None, 3, "y"), ("c", 0, "z")], key=repr
    )
    with pytest.raises(ValueError):
        dedup.keep_last(frame, ["k"], [])


def test_keep_last_sorts_by_a_hash_of_the_grain(spark, rows):
    # Keys that begin alike share their sort prefix, so that each comparison would read them whole.
    frame = spark.createDataFrame([("2024-01-01", "a", 1, "x"), ("2024-01-01", "a", 2, "y"), ("2024-01-02", "a", 1, "z")], "d string, k string, o int, v string")
    last = dedup.keep_last(frame, ["d", "k"], ["o"])
    assert rows(last) == [("2024-01-01", "a", 2, "y"), ("2024-01-02", "a", 1, "z")]
    plan = last._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate(key=[_grain" in plan or "keys=[_grain" in plan or "xxhash64(d" in plan


@pytest.mark.parametrize("repeats", [0, 1, 30])
def test_keep_last_of_scan_moves_only_repeated_grains(spark, rows, tmp_path, repeats):
    again = [("k3", 100 + n, "late") for n in range(repeats)] + [(None, 100 + n, "null") for n in range(repeats)]
    items = [(None, 7, "x"), *[(f"k{n}", n, "v") for n in range(60)], *again]
    spark.createDataFrame(items, "k string, o int, v string").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    last = dedup.keep_last_of_scan(frame, ["k"], ["o"])
    assert rows(last, *frame.columns) == rows(dedup.keep_last(frame, ["k"], ["o"])) and len(rows(last)) == 61
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    assert ("max_by" in plan, "LeftAnti" in plan) == (repeats > 0, repeats == 1)


def test_keep_last_keeps_null_attributes_of_the_winner(spark, rows):
    frame = spark.createDataFrame([("a", 1, "old"), ("a", 2, None)], "k string, o int, v string")
    assert rows(dedup.keep_last(frame, ["k"], ["o"])) == [("a", 2, None)]


def test_merge_first_run_overlap_and_null_keys(spark, rows):
    target = spark.createDataFrame([(day(0), "a", 1.0), (day(0), None, 2.0), (day(1), "b", 3.0)], FRAME)
    source = spark.createDataFrame([(day(0), "a", 9.0), (day(0), None, 8.0), (day(2), "c", 7.0)], FRAME)
    assert rows(upsert.merge_rows(None, source, ["data", "id"])) == rows(source)
    assert rows(upsert.merge_rows(target, source, ["data", "id"])) == sorted(
        [(day(0), "a", 9.0), (day(0), None, 2.0), (day(0), None, 8.0), (day(1), "b", 3.0), (day(2), "c", 7.0)], key=repr
    )
    assert rows(upsert.merge_rows(target, source.limit(0), ["data", "id"])) == rows(target)


def test_merge_of_a_scan_joins_its_keys_alone(spark, rows):
    target = spark.createDataFrame([(day(0), "a", 1.0), (day(0), None, 2.0), (day(1), "b", 3.0)], FRAME)
    source = spark.createDataFrame([(9, "a", day(0)), (8, None, day(0)), (7, "c", day(2))], "m int, id string, data date")
    merged = upsert.merge_rows(target, source, ["data", "id"], scanned=True)
    assert rows(merged) == rows(upsert.merge_rows(target, source, ["data", "id"])) and merged.schema == target.schema
    assert "FullOuter" not in merged._jdf.queryExecution().optimizedPlan().toString()
    part = upsert.merge_rows(target, source.drop("m"), ["data", "id"], scanned=True)
    assert rows(part) == rows(upsert.merge_rows(target, source.drop("m"), ["data", "id"]))


def test_rows_of_equal_attributes_are_one_before_the_latest_is_taken(spark, rows):
    frame = spark.createDataFrame(
        [(1, day(0), "a", None), (1, day(2), "a", None), (1, day(2), "b", 1), (1, None, "z", 9), (2, None, "c", 2), (None, day(0), "d", 3)],
        "id int, data date, name string, n int")
    latest = upsert.dimension_rows(frame, ["id"], ["id", "name", "n"], ["data"])
    assert rows(latest) == [(1, "b", 1), (2, "c", 2)]
    assert "partial_max(data" in latest._jdf.queryExecution().sparkPlan().toString() or "max(data" in latest._jdf.queryExecution().optimizedPlan().toString()


def test_merge_keeps_columns_the_source_lacks_and_refuses_new_ones(spark, rows):
    target = spark.createDataFrame([("a", "kept", 1)], "id string, name string, n int")
    source = spark.createDataFrame([("a", 2), ("b", 3)], "id string, n int")
    assert rows(upsert.merge_rows(target, source, ["id"])) == [("a", "kept", 2), ("b", None, 3)]
    with pytest.raises(ValueError, match="unknown"):
        upsert.merge_rows(target, source.withColumn("extra", F.lit(1)), ["id"])


def test_reload_deletes_absent_days_and_keeps_null_dates(spark, rows):
    target = spark.createDataFrame([(day(0), "a", 1.0), (day(5), "b", 2.0), (day(6), "c", 3.0), (None, "d", 4.0)], FRAME)
    source = spark.createDataFrame([(day(6), "c", 9.0)], FRAME)
    assert rows(upsert.reload_rows(target, source, "data", day(5))) == sorted(
        [(day(0), "a", 1.0), (day(6), "c", 9.0), (None, "d", 4.0)], key=repr
    )
    assert rows(upsert.reload_rows(None, source, "data", day(5))) == rows(source)


def test_scd1_drops_null_keys_and_overwrites_attributes(spark, rows):
    first = spark.createDataFrame([("k", "old", day(0)), ("z", "same", day(0))], "id string, name string, data date")
    second = spark.createDataFrame(
        [("k", "newer", day(2)), ("k", "new", day(1)), (None, "nobody", day(3)), ("k", "a tie", day(2))],
        "id string, name string, data date",
    )
    dim = upsert.scd1(None, first, ["id"], ["id", "name"], ["data"])
    assert rows(upsert.scd1(dim, second, ["id"], ["id", "name"], ["data"])) == [("k", "newer"), ("z", "same")]


rows_strategy = st.lists(
    st.tuples(st.integers(0, 4).map(day), st.sampled_from(["a", "b", "c"]), st.integers(0, 9).map(float)),
    max_size=10, unique_by=lambda row: row[:2],
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_strategy, rows_strategy)
def test_merge_properties(spark, rows, target_rows, source_rows):
    target, source = spark.createDataFrame(target_rows, FRAME), spark.createDataFrame(source_rows, FRAME)
    merged = upsert.merge_rows(target, source, ["data", "id"])
    expected = {row[:2]: row for row in target_rows} | {row[:2]: row for row in source_rows}
    assert rows(merged) == sorted(expected.values(), key=repr)
    assert rows(upsert.merge_rows(merged, source, ["data", "id"])) == rows(merged)


def test_window_start_and_load_window():
    assert windows.window_start(None, 10) == dt.date(1970, 1, 1)
    assert windows.window_start(day(10), 10) == DAY
    assert windows.load_window(None, 10, 90, day(0)) == (day(-90), day(0))
    assert windows.load_window(day(-1), 10, 90, day(0)) == (day(-11), day(0))
    assert windows.load_window(day(-1), 10, 90, day(0), (day(-50), day(-40))) == (day(-50), day(-40))
    # A start alone counts only on the first load.
    assert windows.load_window(None, 10, 90, day(0), (day(-50), None)) == (day(-50), day(0))
    assert windows.load_window(day(-1), 10, 90, day(0), (day(-50), None)) == (day(-11), day(0))


def test_date_slices_tile_and_tolerate_an_empty_range(spark, rows):
    bounds = spark.createDataFrame([(day(0), day(30)), (day(5), day(4))], "lo date, hi date")
    assert rows(windows.date_slices(bounds, "lo", "hi", 14)) == [
        (day(0), day(13)), (day(14), day(27)), (day(28), day(30))
    ]


def test_scan_window_drops_null_dates(spark, rows):
    frame = spark.createDataFrame([(day(0), "a", 1.0), (day(9), "b", 1.0), (None, "c", 1.0)], FRAME)
    assert rows(windows.scan_window(frame, "data", day(5)), "id") == [("b",)]


def test_exclusions_drop_null_ids(spark, rows):
    frame = spark.createDataFrame([(1,), (2,), (None,), (3,)], "id int")
    listed = spark.createDataFrame([(2,), (None,)], "other int")
    assert rows(quality.exclude_ids(frame, "id", [2])) == [(1,), (3,)]
    assert rows(quality.exclude_ids(frame, "id", listed)) == [(1,), (3,)]


def test_any_positive_counts_whole_units_only(spark, rows):
    frame = spark.createDataFrame(
        [("a", "0.2", None), ("b", None, "0.9"), ("c", "x", "1"), ("d", "NaN", "0"), ("e", "-1", None)],
        "id string, amount string, n string",
    )
    assert rows(quality.any_positive(frame, ["amount"], ["n"]), "id") == [("a",), ("c",)]


def test_gates(spark):
    frame = spark.createDataFrame([("d1", None), ("d1", "k"), ("d2", "k")], "day string, id string")
    with pytest.raises(quality.GateError, match=r"without id: d1 \(1\)"):
        quality.require_keys(frame, "day", "id")
    quality.require_keys(frame.dropna(), "day", "id")
    with pytest.raises(quality.GateError, match="lacks"):
        quality.require_snapshot(frame, ["day", "price"])
    with pytest.raises(quality.GateError, match="no rows"):
        quality.require_snapshot(frame.limit(0), ["day"])


def test_duplicate_audit_and_row_counts(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    assert rows(quality.duplicate_keys(frame, ["id"])) == [(1, 2)]
    assert rows(quality.row_counts({"t": frame, "empty": frame.limit(0)})) == [("empty", 0), ("t", 3)]


def test_expired_versions_keep_what_the_window_needs(spark, rows):
    at = dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)
    commits = [(n, at - dt.timedelta(hours=hours)) for n, hours in enumerate([400, 300, 200, 100, 1])]
    listing = spark.createDataFrame(commits, "version bigint, committed_at timestamp")
    # Version 2 was current 168 hours ago, so it stays although it is older than that.
    assert rows(upkeep.expired_versions(listing, at, 168), "version") == [(0,), (1,)]


def test_null_keys_of_a_lookup_are_spread(spark):
    frame = spark.range(2000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("n"))
    table = spark.createDataFrame([("x", "label")], "k string, v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.left_join(frame, table, ["k"])
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 500


def test_lookup_defaults_only_where_unmatched(spark, rows):
    frame = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, n int")
    table = spark.createDataFrame([("x", "label"), (None, "never")], "k string, v string")
    assert rows(lookups.lookup(frame, table, ["k"], {"v": ""})) == sorted(
        [("x", 1, "label"), ("y", 2, ""), (None, 3, "")], key=repr
    )


CREATIVES = """ad_id string, creative struct<
    object_story_spec: struct<video_data: struct<video_id: string>>,
    asset_feed_spec: struct<videos: array<struct<video_id: string>>>,
    effective_object_story_id: string, object_story_id: string>"""
VIDEOS = "id string, permalink_url string, picture string, thumbnails struct<data: array<struct<uri: string>>>"


def test_creatives_resolve_video_then_post_then_nothing(spark, rows):
    def creative(story=None, feed=None, effective=None, own=None):
        return (((story,),), ([(item,) for item in feed or []],), effective, own)

    creatives = spark.createDataFrame([
        ("story", creative("1", ["2"], "9_9")), ("feed", creative("", ["", "2"])), ("unknown video", creative("404")),
        ("post", creative(None, None, "5_6")), ("own post", creative(None, [], "", "7_8")), ("empty", creative()),
        ("none", None),
    ], CREATIVES)
    videos = spark.createDataFrame([
        ("1", "/p/videos/1/", "", ([("thumb",), ("other",)],)), ("2", "https://x/2", "pic", None),
    ], VIDEOS)
    posts = spark.createDataFrame([("5_6", "https://x/videos/77/", None)], "id string, permalink_url string, full_picture string")
    site, watch = "https://www.facebook.com", "https://www.facebook.com/watch/?v="
    assert rows(lookups.resolve_creatives(creatives, videos, posts)) == sorted([
        ("story", watch + "1", watch + "1", "thumb"), ("feed", "https://x/2", "https://x/2", "pic"),
        ("unknown video", watch + "404", watch + "404", ""), ("post", "https://x/videos/77/", watch + "77", ""),
        ("own post", site + "/7/posts/8", site + "/7/posts/8", ""), ("empty", "", "", ""), ("none", "", "", ""),
    ], key=repr)
