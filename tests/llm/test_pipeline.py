import duckdb
import pathlib
from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from llm_paths import SF
from lakemart.llm.catalog import QUERIES
from lakemart.llm.common import stored
from test_exact import brute as exact_groups
from test_minhash import brute as near_groups
from test_packing import check


def test_stages(spark):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        kept.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    language, exact, near, mixed, pieces = kept
    rows = [(row["doc_id"], row["text"]) for row in language.collect()]
    assert len(rows) >= 0.98 * spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sorted(row["doc_id"] for row in exact.collect()) == sorted({keep for _, keep, _ in exact_groups(rows)})
    groups = near_groups([(row["doc_id"], row["text"]) for row in exact.collect()], 5)
    assert sorted(row["doc_id"] for row in near.collect()) == sorted({root for _, root in groups.values()})
    words = lambda frame: sum(len((row["text"] or "").encode().split()) for row in frame.collect())
    assert words(mixed) == pytest.approx(1.5 * words(near), rel=0.2)
    placed = pieces.collect()
    check(placed)
    assert sum(row["piece"] == 0 for row in placed) == mixed.count()


HARD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "the cat sat on the mat and the dog ran " * 3000, "en", "a"), (4, "the cat and the dog", "en", None),
    (4, "the cat and the dog", "en", None), (5, "the cat and the dog", None, "b"), (None, "the cat and the dog", "en", "b"), (None, None, None, None),
    (6, "one two three four five six seven", "en", "c"), (7, "12 34", "en", "c"), (8, "the mat and the cat", "en", "c"),
]


def test_hard_rows_pass_every_stage(spark):
    clashing = [f"{i} as `{name}`" for i, name in enumerate(["id", "row", "kept", "language", "mark", "copies", "node", "digest", "size", "key"])]
    docs = spark.createDataFrame(HARD, "doc_id long, text string, lang string, source string").selectExpr("*", *clashing)
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    language, exact, near, mixed, pieces = seen
    # Rows that repeat id and text go or stay together.
    assert language and sum(row["doc_id"] == 4 for row in language) in (0, 2)
    kept = [(row["doc_id"], row["text"]) for row in language]
    assert Counter(row["doc_id"] for row in exact) == Counter({keep for _, keep, _ in exact_groups(kept)})
    assert len({row["text"] or "" for row in exact}) == len(exact)
    assert {row["doc_id"] for row in near} <= {row["doc_id"] for row in exact}
    assert {row["doc_id"] for row in mixed} <= {row["doc_id"] for row in near}
    check(pieces)
    assert sum(row["piece"] == 0 for row in pieces) == len(mixed)


def test_an_empty_table_passes_every_stage(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.count() == 0


def test_registered():
    assert {"pipeline", *QUERIES} <= set(queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", [name for name, entry in QUERIES.items() if entry.sql])
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(SF).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    got, wanted = queries()[name](spark, SF).toArrow(), connection.sql(oracle_sql()[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(wanted.column_names)
    rows = lambda table: sorted(zip(*[table.column(column).to_pylist() for column in names]))
    assert rows(got) == rows(wanted)
