import datetime as dt
import io
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakemart.operators.dedup import keep_last
from lakemart.operators.quality import GateError
from lakemart.sources import landing
from lakemart.sources.files import file_listing

RUN = dt.date(2024, 2, 1)
SCHEMA = "id string, v bigint"


def write_json(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, ensure_ascii=False, indent=2), encoding="utf-8")


def test_json_arrays_of_one_date_in_file_order(spark, rows, tmp_path):
    run = tmp_path / "ingestion_date=2024-02-01"
    write_json(run / "sales_2.json", [{"id": "a", "v": 3}, {"id": "b"}])
    write_json(run / "sales_1.json", [{"id": "a", "v": 1}, {"id": "a", "v": 2}, {"id": "c", "v": 9}])
    write_json(run / "ignored.txt", [{"id": "x", "v": 0}])
    write_json(tmp_path / "ingestion_date=2024-01-31" / "sales_9.json", [{"id": "old", "v": 0}])
    records = landing.read_partition(spark, str(tmp_path), RUN, SCHEMA, arrays=True)
    last = keep_last(records, ["id"], [landing.ARRIVAL])
    assert rows(last, "id", "v") == sorted([("a", 3), ("b", None), ("c", 9)], key=repr)


def test_malformed_json_fails_the_load(spark, tmp_path):
    path = tmp_path / "ingestion_date=2024-02-01" / "bad.json"
    path.parent.mkdir()
    path.write_text('[{"id": "a"}, {"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_partition(spark, str(tmp_path), RUN, SCHEMA, arrays=True).collect()


def test_a_missing_date_is_empty_and_never_an_older_one(spark, tmp_path):
    write_json(tmp_path / "ingestion_date=2024-01-31" / "a.json", [{"id": "old"}])
    records = landing.read_partition(spark, str(tmp_path), RUN, SCHEMA)
    assert records.columns == ["id", "v", landing.ARRIVAL] and records.isEmpty()


def test_order_holds_inside_a_split_file(spark, rows, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = tmp_path / "ingestion_date=2024-02-01" / "big.json"
    path.parent.mkdir()
    path.write_text("".join(json.dumps({"id": f"k{n % 7}", "v": n}) + "\n" for n in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = landing.read_partition(spark, str(tmp_path), RUN, SCHEMA)
        assert records.rdd.getNumPartitions() > 1
        last = rows(keep_last(records, ["id"], [landing.ARRIVAL]), "v")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert last == [(n,) for n in range(4993, 5000)]


def test_promotion_replaces_same_names_and_empties_the_stage(spark, rows, tmp_path):
    stage, raw = str(tmp_path / "stage"), str(tmp_path / "raw")

    def land(v):
        frame = spark.createDataFrame([("a", v, dt.date(2024, 1, 1)), ("n", v, None)], SCHEMA + ", event_date date")
        landing.stage_by_day(frame, stage, "event_date")

    for v in (1, 2):
        land(v)
        assert landing.promote(spark, stage, raw, RUN, [".json"]) == 1
    assert landing.promote(spark, stage, raw, RUN, [".json"]) == 0
    (tmp_path / "stage" / "late.JSON").write_text('{"id": "late", "v": 5}')
    write_json(tmp_path / "stage" / "notes.txt", [])
    assert landing.promote(spark, stage, raw, RUN, [".json"]) == 1
    assert (tmp_path / "stage" / "notes.txt").exists()
    assert rows(landing.read_partition(spark, raw, RUN, SCHEMA), "id", "v") == [("a", 2), ("late", 5)]


def test_latest_drop(spark, tmp_path):
    root = tmp_path / "raw"
    for name in ("ingestion_date=2024-01-01/z.xlsx", "ingestion_date=2024-02-01/b.XLSX", "ingestion_date=2024-02-01/a.xlsx",
                 "ingestion_date=2024-03-01/c.csv", "other/d.xlsx"):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    with pytest.raises(GateError, match="several drops: a.xlsx, b.XLSX"):
        landing.latest_drop_path(spark, str(root), [".xlsx"])
    assert landing.latest_drop_path(spark, str(root), [".xlsx"], first_only=True).endswith("ingestion_date=2024-02-01/a.xlsx")
    assert landing.latest_drop_path(spark, str(root), [".csv"]).endswith("ingestion_date=2024-03-01/c.csv")
    assert landing.latest_drop_path(spark, str(root), [".xls"]) is None
    assert landing.latest_drop_path(spark, str(tmp_path / "none"), [".xls"]) is None


def test_inbox_names(spark, tmp_path):
    for name in ("a.CSV", "b.csv", "~a.csv", "+a.csv", "c.txt"):
        (tmp_path / name).write_text("x")
    listing = file_listing(spark, str(tmp_path))
    found = listing.where(landing.is_inbox_file(F.col("file_name"), [".csv"])).select("file_name").collect()
    assert sorted(row[0] for row in found) == ["a.CSV", "b.csv"]


def test_csv_keeps_empty_text_apart_from_null(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('Mês,n\n"",1\n,2\nx,\n', encoding="utf-8")
    assert rows(landing.read_csv(spark, str(tmp_path / "a.csv"))) == sorted([("", "1"), (None, "2"), ("x", None)], key=repr)


def test_workbooks_by_injected_decoder(spark, rows, tmp_path):
    for n in range(3):
        (tmp_path / f"book{n}.xlsx").write_bytes(f"ID Venda,extra,Nome\n{n},x,né {n}\n".encode())

    def decode(content):
        return pd.read_csv(io.BytesIO(content))

    book = landing.read_drop(spark, str(tmp_path / "book1.xlsx"), decode=decode)
    assert book.columns == ["ID Venda", "extra", "Nome"] and rows(book) == [("1", "x", "né 1")]
    schema = "`ID Venda` bigint, Nome string"
    assert rows(landing.read_workbooks(spark, str(tmp_path), schema, decode)) == [(n, f"né {n}") for n in range(3)]
    with pytest.raises(Exception, match="absent"):
        landing.read_workbooks(spark, str(tmp_path), "absent string", decode).collect()


def test_quoted_csv(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('t,n\n"a ""b"" c",1\n"p, ""q"", r",2\n"line 1\nline 2",3\n')
    read = landing.read_drop(spark, str(tmp_path / "a.csv"))
    assert rows(read) == sorted([('a "b" c', "1"), ('p, "q", r', "2"), ("line 1\nline 2", "3")])
    (tmp_path / "b.csv").write_text("t,n\n1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_csv(spark, str(tmp_path / "b.csv"), "t string, n int").collect()


def test_a_partition_without_a_schema_keeps_every_field(spark, rows, tmp_path):
    write_json(tmp_path / "ingestion_date=2024-02-01" / "a.json", [{"id": "a", "plan": {"name": "n", "code": 3}}, {"id": "b", "extra": True}])
    read = landing.read_partition(spark, str(tmp_path), RUN, None, arrays=True)
    assert read.columns == ["extra", "id", "plan", landing.ARRIVAL]
    assert rows(read, "id", "plan.code", "extra") == sorted([("a", 3, None), ("b", None, True)], key=repr)
    assert landing.read_partition(spark, str(tmp_path), RUN + dt.timedelta(days=1), None).isEmpty()
