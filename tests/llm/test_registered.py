"""Every registered query of an operator on the smallest tables: its columns, its rows, and digests computed anew."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from llm_paths import SF
from lakemart.llm.tokens import vocabulary_path

CONTRACT = {
    "op1_language_id": {"doc_id"},
    "op2_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op3_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op4_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op5_pivot_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op7_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8_warc_archives": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op10_minhash_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
}


@pytest.fixture(scope="module")
def found(spark):
    from lakemart.llm.common import let_workers_import

    let_workers_import(spark)
    return {name: [row.asDict() for row in queries()[name](spark, SF).collect()] for name in CONTRACT}


@pytest.fixture(scope="module")
def texts(spark):
    return {row["doc_id"]: row["text"] or "" for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_and_rows(spark, found, texts, name):
    rows, column = found[name], next(iter(sorted(CONTRACT[name] & {"doc_id", "vec_id", "page_id"})))
    assert all(CONTRACT[name] <= set(row) for row in rows)
    table = {"doc_id": "documents", "vec_id": "embeddings", "page_id": "pages"}[column]
    wanted = Counter(row[column] for row in spark.read.parquet(f"{SF}/{table}.parquet").select(column).collect())
    got = Counter(row[column] for row in rows)
    assert set(got) == set(wanted) and (name == "op2_best_fit_packing" or got == wanted)


def ids_of(text):
    return np.array(tokenizer().encode(text, add_special_tokens=False).ids, "<u4")


def tokenizer(held=[]):  # noqa: B006
    if not held:
        held.append(Tokenizer.from_file(vocabulary_path()))
    return held[0]


def test_packed_digests(found, texts):
    for row in found["op2_best_fit_packing"]:
        ids = np.append(ids_of(texts[row["doc_id"]]), np.uint32(0)).astype("<u4")[row["start"]:row["start"] + row["length"]]
        assert len(ids) == row["length"] and zlib.crc32(ids.tobytes()) == row["ids_crc32"]


def test_file_digests(found, texts):
    start = 0
    for row in sorted(found["op7_token_files"], key=lambda row: row["doc_id"]):
        ids = np.append(ids_of(texts[row["doc_id"]]), np.uint32(2)).astype("<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_span_digests(found, texts):
    patterns = [
        ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
        ("access", r"AKIA[A-Z0-9]+", 18, 0), ("hex", r"[0-9a-f]+", 16, 0)]
    for row in found["op3_secret_scan"]:
        spans = [(m.start(), number, name, m.end()) for number, (name, pattern, least, group) in enumerate(patterns)
                 for m in re.finditer(pattern, texts[row["doc_id"]], re.ASCII) if len(m[group]) >= least]
        joined = ",".join(f"{name}:{start}:{end}" for start, _, name, end in sorted(spans))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))


def test_license_phrases(found, texts):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for row in found["op4_license_scan"]:
        lowered = texts[row["doc_id"]].translate({code: code + 32 for code in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for phrase, label in phrases.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        labels = sorted({label for _, label in places})
        starts = sorted(i for i, _ in places)
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(words), len(places), ",".join(labels))
        assert (row["first_word"], row["last_word"]) == ((starts[0], starts[-1]) if starts else (None, None))
        assert set(labels) <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1
