import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakemart.llm.exact import DedupState, exact_groups, fingerprints, keep_first, sha256
from lakemart.session import scratch_path

ROWS = [(3, "a  b"), (1, "a b"), (2, None), (5, ""), (None, "q"), (7, "q"), (7, "q"), (8, "zz\n"), (9, "zz "), (10, "long " * 50_000)]


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    found = []
    for ids in groups.values():
        known = [key for key in ids if key is not None]
        found += [(key, min(known) if known else None, len(ids)) for key in ids]
    return sorted(found, key=repr)


@pytest.mark.parametrize("digest", [sha256, lambda text: F.substring(sha256(text), 1, 0)], ids=["sha256", "all collide"])
def test_groups(documents, rows, digest):
    found = exact_groups(documents(ROWS), digest=digest)
    assert rows(found, "id", "keep_id", "group_size") == brute(ROWS)
    assert rows(found.where("kept"), "keep_id") == sorted({(keep,) for _, keep, _ in brute(ROWS)}, key=repr)


def test_kept_rows_have_all_their_columns(documents):
    frame = documents(ROWS)
    kept = keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [1, 2, 7, 8, 10]


def test_empty_table(documents):
    assert exact_groups(documents([])).count() == 0 and keep_first(documents([])).count() == 0


def test_state_goes_on_over_batches_and_loads(spark, documents):
    frame = documents([(i, f"text {i % 5}") for i in range(40)]).repartition(6)
    first, folder = fingerprints(frame, "doc_id", "text", sha256)
    state = DedupState(spark, scratch_path(spark, "state"))
    state.add(folder, first.schema, batch_bytes=1)
    assert sorted((row["first"]["id"], row["n"]) for row in state.groups().collect()) == [(i, 8) for i in range(5)]
    # The same files again bring nothing; a later load is matched with the state of the earlier one.
    state.add(folder, first.schema)
    more, _ = fingerprints(documents([(-1, "text 3"), (99, "new")]), "doc_id", "text", sha256)
    more.write.mode("append").parquet(folder)
    state.add(folder, first.schema)
    assert sorted((row["first"]["id"], row["n"]) for row in state.groups().collect()) == [(-1, 9), (0, 8), (1, 8), (2, 8), (4, 8), (99, 1)]
