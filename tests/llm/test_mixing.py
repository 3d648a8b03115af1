import pytest
from pyspark.sql import functions as F

from llm_paths import SF

from lakemart.llm.mixing import apply_mix, label_weights, mixed, targets


def brute_targets(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    """Excess over the limit is shared again and again until no source is above."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    target, full, rest = dict.fromkeys(names, 0.0), set(), budget * sum(sizes.values())
    while rest > 1e-9:
        free = [name for name in names if name not in full]
        total = sum(weight[name] for name in free)
        for name in free:
            target[name] += rest * weight[name] / total
        rest = 0
        for name in free:
            if target[name] > most * sizes[name]:
                rest += target[name] - most * sizes[name]
                target[name], _ = float(most * sizes[name]), full.add(name)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 7, None: 400}, {"a": 5}, {"a": 0, "b": 3}, {chr(97 + i): (i * 7919) % 500 for i in range(20)}, {"a": 0}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row["source"]: row["target"] for row in targets(frame, (5, 2, 1), 1.5, 2).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_every_source_comes_near_its_target(spark):
    frame, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    found = mixed(frame, label_weights(labels)).withColumn("taken", F.col("size") * F.col("copies"))
    again = mixed(frame.repartition(5), label_weights(labels)).withColumn("taken", F.col("size") * F.col("copies"))
    assert sorted(found.collect()) == sorted(again.collect())
    for row in found.groupBy("source", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("longest")).collect():
        assert abs(row["taken"] - row["target"]) <= row["longest"] / 2
    assert found.where("copies > 2 or copies < 0").count() == 0


def test_cells_do_not_change_the_sample(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(mixed(frame, cells=1).collect()) == sorted(mixed(frame, cells=100_000).collect())


def test_better_documents_come_first(spark):
    frame = spark.range(4000).selectExpr("id as doc_id", "'x' as source", "'w w' as text")
    quality = frame.selectExpr("doc_id as id", "if(doc_id < 2000, 9.0, 1.0) as weight")
    taken = mixed(frame, quality, budget=0.25).where("copies = 1")
    assert taken.count() == 1000 and taken.where("id < 2000").count() > 800


def test_nulls_repeats_and_clashing_columns(documents):
    frame = documents([(1, "a b c"), (1, "a b c"), (None, "x"), (2, None), (3, ""), (4, "q " * 30_000)])
    found = mixed(frame)
    assert found.count() == 6
    repeated = apply_mix(frame, found)
    assert repeated.columns == frame.columns
    times = {row["doc_id"]: row["n"] for row in repeated.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    copies = {row["id"]: row["copies"] for row in found.collect()}
    assert all(times.get(key, 0) == copies[key] for key in (None, 2, 3, 4))


@pytest.mark.parametrize("cells", [1, 8, 100_000])
def test_wordless_documents_of_a_full_source_come_no_third_time(spark, cells):
    rows = [(i, "a", "" if i % 2 else "w " * 10) for i in range(80)] + [(100 + i, "b", "w " * 1000) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = mixed(frame, cells=cells)
    assert {row["copies"] for row in found.where("source = 'a'").collect()} == {2}
    assert apply_mix(frame, found).where("source = 'a'").count() == 160


def test_as_many_sources_as_documents(spark):
    sizes = {f"host-{i}": (i * 7919) % 3000 for i in range(3000)} | {None: 5000}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row["source"]: row["target"] for row in targets(frame, (5, 2, 1), 1.5, 2).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_empty_table(documents):
    assert mixed(documents([])).count() == 0
