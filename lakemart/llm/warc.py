"""WARC archives: one gzip member per record, written and read by Spark.

Writing. Records of equal payload (same SHA-1 and length) have one response, the one with the largest id
and the payload; the others are revisits that name it and hold only the HTTP header. A task strings the
members of its records together into archives of about ``ARCHIVE_BYTES``, and Spark's text writer puts
each down as one file: a binary column passes it unchanged, and the line end it needs after a row is an
empty gzip member, which every gzip reader skips. So files appear through Spark's committer, on any store.

Reading is sequential: the members are inflated by and by, a record's header ends at an empty line, its
block has the length the header states, and its digests are computed anew. A broken frame or a wrong
digest fails the read.

Defined results: a null payload is empty; a very long one is a record like others, inflated in small steps; null ids count as smaller than every id and a null id that is
referred to reads as null; rows that repeat id and payload are each a record of their own, all responses
where the id is the largest; an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.common import name_of, split_by_bucket, text_of

ARCHIVE_BYTES = 8 * 2**20
LEVEL = 4
READ_BYTES = 2**16
#: An empty gzip member in Latin-1, the charset in which the line separator keeps its bytes.
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "2000-01-01T00:00:00Z"


def _urn(identifier: int | None) -> str:
    return f"<urn:x-row:{'' if identifier is None else identifier}>"


def _id(urn: str) -> int | None:
    number = urn.removeprefix("<urn:x-row:").removesuffix(">")
    return int(number) if number else None


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def member(identifier: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(identifier)),
        ("WARC-Date", CAPTURED), ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", _base32(digest)), ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(head.encode() + block + b"\r\n\r\n") + deflate.flush()


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> None:
    """A record per row, in archives below ``path``."""
    rows = pages.select(name_of(id_column).cast("long").alias("id"), name_of(url_column).cast("string").alias("url"),
                        text_of(payload_column).cast("binary").alias("payload"))
    # Only ids and digests are grouped; a payload many rows share is one row per task.
    groups = rows.groupBy(F.sha1("payload").alias("digest"), F.octet_length("payload").alias("long")).agg(
        F.max("id").alias("owner"), F.count(F.lit(1)).alias("n"))
    shared = groups.where("n > 1").select("digest", "long", "owner")
    keyed = rows.withColumn("digest", F.sha1("payload")).withColumn("long", F.octet_length("payload"))
    # Payloads nobody shares stay where they are; only the others are moved to their owner's id.
    repeated, alone = split_by_bucket(keyed, F.col("digest"), shared, F.col("digest"))
    revisit = F.coalesce(F.col("id") != F.col("owner"), F.col("owner").isNotNull() & F.col("id").isNull())
    marked = repeated.join(shared, ["digest", "long"], "left").unionByName(
        alone.withColumn("owner", F.lit(None).cast("long")))
    marked = marked.select("id", "url", "payload", F.unhex("digest").alias("digest"), "owner", revisit.alias("revisit"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, held = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                members.append(member(*(batch.column(i)[row].as_py() for i in range(6))))
                held += len(members[-1])
                if held >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)])], ["archive"])
                    members, held = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)])], ["archive"])

    archives = marked.mapInArrow(archive, "archive binary").select(F.col("archive").cast("string").alias("value"))
    (archives.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER)
     .option("maxRecordsPerFile", 1).text(path))


class Inflater:
    """The bytes of an archive, member after member, inflated in small steps."""

    def __init__(self, archive: bytes):
        self.archive, self.at = memoryview(archive), 0
        self.ready = bytearray()
        self.zip = None

    def _more(self) -> bool:
        if self.at >= len(self.archive) and self.zip is None:
            return False
        if self.zip is None:
            self.zip = zlib.decompressobj(31)
        step = self.archive[self.at:self.at + READ_BYTES]
        if not len(step):
            raise ValueError("the archive ends inside a member")
        self.ready += self.zip.decompress(step)
        self.at += len(step)
        if self.zip.eof:
            self.at -= len(self.zip.unused_data)
            self.zip = None
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        seen = 0
        while (end := self.ready.find(b"\r\n", seen)) < 0:
            seen = max(0, len(self.ready) - 1)
            if not self._more():
                if self.ready:
                    raise ValueError("the archive ends inside a line")
                return None
        found = bytes(self.ready[:end])
        del self.ready[:end + 2]
        return found

    def take(self, count: int) -> bytes:
        while len(self.ready) < count:
            if not self._more():
                raise ValueError("the archive ends inside a block")
        found = bytes(self.ready[:count])
        del self.ready[:count]
        return found


def _fields(source: Inflater) -> dict[str, str]:
    found = {}
    while line := source.line():
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records(archive: bytes) -> Iterator[dict]:
    """The records of one archive, in order, each checked against its lengths and digests."""
    source = Inflater(archive)
    while (version := source.line()) is not None:
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = _fields(source)
        block = source.take(int(fields["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"{fields['warc-record-id']}: the block is longer than stated")
        if _base32(hashlib.sha1(block).digest()) != fields["warc-block-digest"]:
            raise ValueError(f"{fields['warc-record-id']}: wrong block digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
        if fields["warc-type"] == "response" and (
                len(payload) != stated or _base32(hashlib.sha1(payload).digest()) != fields["warc-payload-digest"]):
            raise ValueError(f"{fields['warc-record-id']}: the payload is not the one that was stored")
        refers_to = fields.get("warc-refers-to")
        yield {
            "id": _id(fields["warc-record-id"]), "url": fields["warc-target-uri"], "record_type": fields["warc-type"],
            "payload_bytes": stated, "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
            "refers_to": _id(refers_to) if refers_to else None, "payload": payload,
        }


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Per record: id, url, record_type, payload_bytes, payload_digest, refers_to and, if wanted, payload."""
    schema = "id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    arrow = [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    if with_payload:
        schema, arrow = schema + ", payload binary", [*arrow, ("payload", pa.binary())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for record in records(archive.as_py()):
                    rows.append(record)
                    held += len(record["payload"]) if with_payload else 200
                    if held >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(arrow))
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(arrow))

    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary").load(path)
    return files.select("content").mapInArrow(read, schema)
