import base64
import gzip
import hashlib
import pathlib

import pytest

from llm_paths import SF

from lakemart.llm.warc import member, read_archives, records, write_archives
from lakemart.session import scratch_path


def archived(spark, frame):
    path = scratch_path(spark, "archives")
    write_archives(frame, path)
    return path, read_archives(spark, path)


def test_round_trip_of_every_page(spark):
    frame = spark.read.parquet(f"{SF}/pages.parquet")
    path, found = archived(spark, frame)
    pages = {row["page_id"]: row["html"] or "" for row in frame.collect()}
    owner = {}
    for key, html in pages.items():
        owner[html] = max(key, owner.get(html, key))
    rows = found.collect()
    assert len(rows) == len(pages)
    for row in rows:
        raw = pages[row["id"]].encode()
        response = owner[pages[row["id"]]] == row["id"]
        assert row["payload_bytes"] == len(raw) and row["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert row["record_type"] == ("response" if response else "revisit")
        assert bytes(row["payload"]) == (raw if response else b"")
        assert row["refers_to"] == (None if response else owner[pages[row["id"]]])
    files = list(pathlib.Path(path.removeprefix("file:")).glob("part-*"))
    assert files and all(gzip.open(file).read().startswith(b"WARC/1.1") for file in files)


def test_nulls_ties_and_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, "u", "a"), (5, "u", "a"), (None, None, "é"), (4, "x\r\ny", "é"), (6, "z", None), (7, "z", ""), (7, "z", ""), (None, "n", "n"),
         (9, "long", "x" * 3_000_000)], "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as owner", "3 as id")
    rows = archived(spark, frame)[1].collect()
    got = sorted(((row["id"], row["record_type"], row["refers_to"], row["payload_bytes"]) for row in rows), key=repr)
    assert got == sorted([
        (1, "revisit", 5, 1), (5, "response", None, 1), (None, "revisit", 4, 2), (4, "response", None, 2), (6, "revisit", 7, 0),
        (7, "response", None, 0), (7, "response", None, 0), (None, "response", None, 1), (9, "response", None, 3_000_000)], key=repr)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert archived(spark, frame)[1].count() == 0


def one(payload=b"some text"):
    return member(3, "u", payload, hashlib.sha1(payload).digest(), None, False)


def test_reader_refuses_what_does_not_match():
    assert [row["id"] for row in records(one() * 3)] == [3, 3, 3]
    plain = gzip.decompress(one())
    for damaged in (plain.replace(b"some", b"Some"), plain[:-1], plain + b"x", plain.replace(b"sha1:", b"sha1:A"),
                    plain.replace(b"Content-Length: 9", b"Content-Length: 8")):
        with pytest.raises(ValueError):
            list(records(gzip.compress(damaged)))
    with pytest.raises(ValueError):
        list(records(one()[:-9]))
