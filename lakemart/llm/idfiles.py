"""Token ids of a corpus as Simple-8b files in document order, written and read by Spark.

The documents are range-partitioned by id, so every file holds a range of them in ascending order and
the files follow each other. A file is a table of chunks; a chunk holds whole documents of about
``CHUNK_IDS`` ids and is decoded by itself. Positions count inside a file; adding the ids of the files
before it, a table of one row per file, gives the place in the corpus. Writing through Spark's own
committer works on any store and survives lost executors.

Defined results: a null text is the empty text, whose only id is the end id; a very long text is a chunk of its own size; null ids come first; rows
that repeat an id follow each other in the order of their texts' digests and share nothing; an empty
table gives no chunks and no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakemart.llm.common import name_of, stored, text_of
from lakemart.llm.simple8b import read_chunk, write_chunk
from lakemart.llm.tokens import encode_runs, released

END_ID = 2
CHUNK_IDS = 2**18
CHUNKS = "file int, chunk int, first long, ids long, documents binary, absent binary, payload binary"


def write_ids(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None,
    end_id: int = END_ID,
) -> None:
    """Encode every text, the end id behind it, and write the files to ``path``."""
    texts = docs.select(name_of(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, chunk, first = TaskContext.get().partitionId(), 0, 0
        names, counts, parts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            payload = write_chunk(np.concatenate(parts), np.concatenate(counts))
            known = np.array([name or 0 for name in names], "<i8").tobytes()
            absent = bytes(name is None for name in names)
            return pa.RecordBatch.from_pylist([{
                "file": file, "chunk": chunk, "first": first, "ids": held, "documents": known, "absent": absent,
                "payload": payload}], schema)

        schema = pa.schema([("file", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("ids", pa.int64()),
                            ("documents", pa.binary()), ("absent", pa.binary()), ("payload", pa.binary())])
        with released():
            for batch in batches:
                own = batch.column(0).to_pylist()
                for at, ids, lengths in encode_runs(batch.column(1), vocabulary):
                    names += own[at:at + len(lengths)]
                    counts.append(lengths + 1)
                    parts.append(np.insert(ids, np.cumsum(lengths), end_id))
                    held += len(parts[-1])
                    if held >= CHUNK_IDS:
                        yield close()
                        chunk, first = chunk + 1, first + held
                        names, counts, parts, held = [], [], [], 0
        if held:
            yield close()

    ordered.select("id", "text").mapInArrow(encode, CHUNKS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit)."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    in_files = Window.partitionBy().orderBy("file").rowsBetween(Window.unboundedPreceding, 0)
    # A row per file, of which there are as many as the writing had tasks.
    files = stored(chunks.groupBy("file").agg(F.sum("ids").alias("n")).select(
        "file", (F.sum("n").over(in_files) - F.col("n")).alias("before")), "id-file-starts")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                file, first, documents, absent, payload = (batch.column(i)[row].as_py() for i in range(5))
                ids, counts = read_chunk(payload)
                raw, ends = ids.astype("<u4"), np.cumsum(counts)
                starts = ends - counts
                known = np.frombuffer(documents, "<i8")
                yield pa.RecordBatch.from_arrays([
                    pa.array(known, mask=np.frombuffer(absent, np.bool_)), pa.array(np.full(len(counts), file, np.int32)),
                    pa.array(starts + first), pa.array(counts),
                    pa.array([raw[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ], ["id", "file", "start", "n_tokens", "ids"])

    decoded = chunks.select("file", "first", "documents", "absent", "payload").mapInArrow(
        decode, "id long, file int, start long, n_tokens long, ids binary")
    return decoded.join(files, "file").select("id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")
