"""Passages that repeat anywhere in the corpus, found with run-length indexes.

A string of ``depth`` bytes that also starts earlier (in a document with a smaller id, or earlier in the same one)
covers bytes that repeat. All starts of such strings are found, without one index of the whole corpus:

1.  Every string of ``depth`` bytes holds an anchor, the gram of ``GRAM`` bytes with the smallest hash, the first
    of equal ones. Equal strings have the same anchor at the same place. The starts that share an anchor are
    one window of text. Anchors that occur once cannot repeat; a filter of the others is
    broadcast, and only their windows are listed, by hash and place.
2.  Equal windows are grouped: all but the earliest repeat as a whole. Windows of one anchor that differ are
    dealt to shards by their anchor, one copy of each, and a task builds a run-length index over the
    windows of its shard, streams all of them through it and marks the starts whose next ``depth`` bytes an
    earlier window has.
3.  An anchor with more than ``GROUP`` different windows is cut: its starts are halved, and each half goes by what all its strings have
    in common, until no group is too large; a single start goes by its whole string, and so ends as one window. No task
    holds more than a shard, whatever one line or passage the corpus repeats.
4.  The marked starts come together per document, and the bytes they cover are cut out of its text.

Texts are read three times and only windows, and documents with marks, are moved. Hashes of 64 bits stand for
windows within an anchor's own hash, so two different windows taken for the same need a collision of both.

Defined results: a null text is empty; texts shorter than ``depth`` have no repeats; very long texts are read in stretches;
a null id counts as larger than every id; rows that repeat an id are one document, whose earlier starts count and
whose equal starts do not, so a repeated row gets its first copy's result; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm import bits
from lakemart.llm.bits import admitted
from lakemart.llm.common import name_of, split_by_bucket, stored, text_of
from lakemart.llm.runindex import RunLengthIndex, seen_earlier

DEPTH = 100
GRAM = 32
#: Bytes read at once; places within them take 21 bits.
RUN_BYTES = 2**20
#: Bytes of windows in one index, and how many different windows of one anchor it may get. Sorting within the
#: processor's cache, an index of this size takes half as long a byte as one eight times as large.
SHARD_BYTES = 256 * 2**10
GROUP = 2048

#: Where a window starts: whether the id is null, the id (then 0), the hash of id and text, the byte.
PLACE = "absent boolean, id long, doc long, start long"


PLACES = np.arange(2**21, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


#: A number of 64 bits for each byte.
BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes from each place on, put together from powers of two and mixed at the end."""
    grown, have, found, got = BYTES[raw], 1, None, 0
    while True:
        if size & have:
            if found is None:
                found = grown
            else:
                both = len(raw) - got - have + 1
                found = found[:both] * np.uint64(0x94D049BB133111EB)
                found += grown[got:got + both]
            got += have
        if got == size:
            return _mix(found)
        # An odd factor of its own for each length.
        longer = grown[:-have] * np.uint64(0xD6E8FEB86659FD93 + 2 * have)
        longer += grown[have:]
        grown, have = longer, 2 * have


def smallest_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` values from each place on."""
    have, least = 1, values
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:len(values) - width + 1], least[width - have:])


def windows(raw: np.ndarray, ends: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, first start, starts, anchor's place) of the windows of texts in a row that end at ``ends``."""
    nothing = np.zeros(0, np.int64)
    if len(raw) < depth:
        return nothing.astype(np.uint64), nothing, nothing, nothing
    hashes = gram_hashes(raw, gram)
    low = np.uint64(2**21 - 1)
    ranked = hashes & ~low
    ranked |= PLACES[:len(hashes)]
    anchor = smallest_ahead(ranked, depth - gram + 1)
    anchor &= low
    # A window begins where the anchor changes, and where a text does.
    begins = np.empty(len(anchor), bool)
    begins[0] = True
    np.not_equal(anchor[1:], anchor[:-1], out=begins[1:])
    starts = np.concatenate([[0], ends[:-1]])
    for start, end in zip(starts.tolist(), ends.tolist()):
        # The last places of a text have no whole string before them.
        begins[max(start, end - depth + 1):end] = False
        if end - start >= depth:
            begins[start] = True
    first = np.flatnonzero(begins)
    last = (ends - depth + 1)[np.searchsorted(ends, first, "right")]
    count = np.minimum(np.append(first[1:], len(raw)), last) - first
    found = anchor[first].astype(np.int64)
    return hashes[found], first, count, found


def stretches(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, rows, offsets): texts of about RUN_BYTES in a row; a longer text in overlapping parts."""
    run, rows, offsets, size = [], [], [], 0
    for row, value in enumerate(batch.column(batch.schema.get_field_index("text")).cast(pa.binary())):
        text = value.as_py()
        for at in range(0, max(1, len(text) - depth + 1), RUN_BYTES):
            part = text[at:at + RUN_BYTES + depth - 1] if len(text) > RUN_BYTES else text
            if run and size + len(part) > RUN_BYTES:
                yield b"".join(run), np.cumsum([len(one) for one in run]), np.array(rows), np.array(offsets)
                run, rows, offsets, size = [], [], [], 0
            run.append(part)
            rows.append(row)
            offsets.append(at)
            size += len(part)
            if len(text) <= RUN_BYTES:
                break
    if run:
        yield b"".join(run), np.cumsum([len(one) for one in run]), np.array(rows), np.array(offsets)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _keys(texts: DataFrame, depth: int, gram: int) -> DataFrame:
    """key, n: anchors with how often a run has them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, ends, _, _ in stretches(batch, depth):
                key, n = np.unique(windows(np.frombuffer(raw, np.uint8), ends, depth, gram)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(key), pa.array(n)], ["key", "n"])

    return texts.select("text").mapInArrow(count, "key long, n long")


def _place_hashes(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    return _mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64))


def _listed(texts: DataFrame, depth: int, gram: int, anchors, places=None) -> DataFrame:
    """Windows of the anchors that a broadcast filter admits: key, win, id, doc, start, starts; with a filter of
    places instead only those, with their anchor (counted from the start) and bytes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {name: batch.column(batch.schema.get_field_index(name)) for name in ("absent", "id", "doc")}
            docs = own["doc"].to_numpy(zero_copy_only=False)
            for raw, ends, rows, offsets in stretches(batch, depth):
                key, first, count, anchor = windows(np.frombuffer(raw, np.uint8), ends, depth, gram)
                text = np.searchsorted(ends, first, "right")
                start = offsets[text] + first - np.concatenate([[0], ends])[text]
                if places is None:
                    at = np.flatnonzero(admitted(key, anchors.value))
                else:
                    at = np.flatnonzero(admitted(_place_hashes(docs[rows[text]], start), places.value))
                if not len(at):
                    continue
                key, first, count, anchor, text, start = (column[at] for column in (key, first, count, anchor, text, start))
                spans = zip(first.tolist(), (first + count + depth - 1).tolist())
                found = {"key": _signed(key), **{name: column.take(pa.array(rows[text])) for name, column in own.items()}, "start": pa.array(start)}
                if places is None:
                    # In the order of the schema below.
                    found["win"] = _signed(np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in spans), np.uint64, len(at)))
                    found["starts"] = pa.array(count.astype(np.int32))
                else:
                    found["anchor"] = pa.array((anchor - first).astype(np.int32))
                    found["bytes"] = pa.array([raw[a:b] for a, b in spans], pa.binary())
                yield pa.RecordBatch.from_pydict(found)

    rest = "win long, starts int" if places is None else "anchor int, bytes binary"
    return texts.mapInArrow(scan, f"key long, {PLACE}, {rest}")


RANK = "struct(absent, id, start)"


def _indexed(windows_: DataFrame, depth: int, shard_bytes: int) -> DataFrame:
    """The marked starts of windows, by one run-length index a shard."""
    total = windows_.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_bytes))

    def mark(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["absent", "id", "start"], ignore_index=True)
        document = (part["absent"].diff().fillna(False).astype(bool) | (part["id"].diff() != 0)).cumsum().to_numpy()
        start = part["start"].to_numpy()
        # A document's places follow each other, with room for 2**40 of them.
        text, place, starts = seen_earlier(RunLengthIndex(part["bytes"].tolist(), depth), document * 2**40 + start)
        found = part[["absent", "id", "doc"]].iloc[text].reset_index(drop=True)
        return found.assign(start=start[text] + place, starts=starts.astype(np.int32))

    return windows_.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInPandas(
        mark, f"{PLACE}, starts int")


def _cut(windows_: DataFrame, depth: int, width: int) -> DataFrame:
    """The windows in parts of at most ``width`` starts, by their distance to the anchor: key, win and the columns of a window.

    The new key is the hash of what all strings of a part's distances have in common, whether the window has them all or not.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
            found = []
            for row, (key, start, anchor, whole) in enumerate(zip(*(column[name].to_pylist() for name in ("key", "start", "anchor", "bytes")))):
                nearest = anchor - (len(whole) - depth)
                for number in range(nearest // width, anchor // width + 1):
                    near, far = max(nearest, number * width), min(anchor, number * width + width - 1)
                    own = whole[anchor - far:anchor - near + depth]
                    core = whole[anchor - number * width:anchor - number * width - width + 1 + depth]
                    seed = (key ^ (number * 0x9E3779B97F4A7C15)) % 2**64
                    found.append((xxhash.xxh3_64_intdigest(core, seed), xxhash.xxh3_64_intdigest(own, near), row, start + anchor - far, far, own))
            keys, wins, rows, starts, anchors, texts = zip(*found)
            yield pa.RecordBatch.from_pydict({
                "key": _signed(np.array(keys, np.uint64)), "win": _signed(np.array(wins, np.uint64)),
                **{name: column[name].take(pa.array(rows)) for name in ("absent", "id", "doc")},
                "start": pa.array(starts, pa.int64()), "anchor": pa.array(anchors, pa.int32()), "bytes": pa.array(texts, pa.binary())})

    return windows_.select("key", "absent", "id", "doc", "start", "anchor", "bytes").mapInArrow(
        cut, f"key long, win long, {PLACE}, anchor int, bytes binary")


def _grouped(listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per different window: key, win, first place, n; per anchor with several of them: key, rivals)."""
    groups = stored(listed.groupBy("key", "win").agg(
        F.min(F.expr("struct(absent, id, start, doc)")).alias("first"), F.count(F.lit(1)).alias("n")), "window-groups")
    return groups, groups.groupBy("key").agg(F.count(F.lit(1)).alias("rivals")).where("rivals > 1")


def _repeated(listed: DataFrame, groups: DataFrame, starts: Column) -> DataFrame:
    """All places of windows but the first ones."""
    again = listed.join(groups.where("n > 1").select("key", "win", "first"), ["key", "win"])
    return again.where(f"{RANK} > struct(first.absent, first.id, first.start)").select("absent", "id", "doc", "start", starts.alias("starts"))


def marked_starts(texts: DataFrame, depth: int, gram: int, shard_bytes: int, group: int) -> DataFrame:
    """absent, id, doc, start, starts: stretches of starts whose next ``depth`` bytes also start earlier."""
    spark = texts.sparkSession
    keys = stored(_keys(texts, depth, gram).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "anchors")
    anchors = spark.sparkContext.broadcast(bits.of_hashes(keys, keys.count()))
    listed = stored(_listed(texts, depth, gram, anchors), "windows")
    anchors.destroy()
    groups, rivals = _grouped(listed)
    marks = [_repeated(listed, groups, F.col("starts"))]

    # One copy of each window that has rivals, with its bytes.
    wanted = stored(groups.join(rivals, "key").select("key", "first.doc", "first.start", "rivals"), "rivals")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            yield pa.RecordBatch.from_arrays([_signed(_place_hashes(doc, start))], ["hash"])

    places = spark.sparkContext.broadcast(bits.of_hashes(wanted.select("doc", "start").mapInArrow(hashes, "hash long"), wanted.count()))
    some, _ = split_by_bucket(texts, F.col("doc"), wanted, F.col("doc"))
    found = _listed(some, depth, gram, None, places).dropDuplicates(["doc", "start"])
    different = stored(found.join(wanted, ["key", "doc", "start"]), "different-windows")
    places.destroy()
    width = depth - gram + 1
    while True:
        marks.append(stored(_indexed(different.where(F.col("rivals") <= group), depth, shard_bytes), "marks"))
        large = different.where(F.col("rivals") > group)
        if large.isEmpty():
            break
        width = math.ceil(width / 2)
        listed = stored(_cut(large, depth, width), "window-parts")
        groups, rivals = _grouped(listed)
        marks.append(_repeated(listed, groups, (F.length("bytes") - depth + 1)))
        first = groups.join(rivals, "key").select("key", "win", "first.doc", "first.start", "rivals")
        different = stored(listed.join(stored(first, "rivals"), ["key", "win", "doc", "start"]), "different-windows")
    result = marks[0]
    for more in marks[1:]:
        result = result.unionByName(more)
    return result


def covered(marks: list[tuple[int, int]], depth: int) -> list[tuple[int, int]]:
    """(start, length) of the bytes that marked starts cover, in order and apart."""
    spans: list[tuple[int, int]] = []
    for start, starts in sorted(marks):
        end = start + starts - 1 + depth
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((start, end))
    return [(start, end - start) for start, end in spans]


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH, gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES, group: int = GROUP,
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, removed (start and length of each span), kept (bytes)."""
    own = name_of(id_column).cast("long")
    texts = docs.select(
        own.isNull().alias("absent"), F.coalesce(own, F.lit(0)).cast("long").alias("id"), text_of(text_column).alias("text")).withColumn(
            "doc", F.xxhash64("absent", "id", "text"))
    marks = marked_starts(texts, depth, gram, shard_bytes, group)
    marks = stored(marks.groupBy("absent", "id", "doc").agg(F.collect_set(F.struct("start", "starts")).alias("marks")), "passages")
    maybe, sure = split_by_bucket(texts, F.col("doc"), marks, F.col("doc"))
    joined = maybe.join(marks, ["absent", "id", "doc"], "left").select("absent", "id", "text", "marks")
    schema = "absent boolean, id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: long, length: long>>, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                text = row.column(2).cast(pa.binary())[0].as_py()
                spans = covered([(mark["start"], mark["starts"]) for mark in row.column(3)[0].as_py() or []], depth)
                ends = [0, *(start + length for start, length in spans)]
                kept = b"".join(text[a:b] for a, b in zip(ends, [*(start for start, _ in spans), len(text)]))
                yield pa.RecordBatch.from_arrays([
                    row.column(0), row.column(1), pa.array([len(text)]), pa.array([len(text) - len(kept)]), pa.array([len(spans)]),
                    pa.array([hashlib.sha256(kept).hexdigest()]),
                    pa.array([[{"start": start, "length": length} for start, length in spans]], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array([kept], pa.binary()),
                ], ["absent", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    none = F.lit(0).cast("long")
    whole = sure.select(
        "absent", "id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        F.array().cast("array<struct<start: long, length: long>>").alias("removed"), F.col("text").cast("binary").alias("kept"))
    return joined.mapInArrow(cut, schema).unionByName(whole).withColumn("id", F.expr("if(absent, null, id)")).drop("absent")
