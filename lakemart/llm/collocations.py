"""Phrases whose words come together, mined by dynamic itemset counting.

The documents are dealt to shards, which are scanned in a cycle. Words are counted from the first scan on. A
longer phrase becomes active once both of its subphrases, without the last and without the first word,
have reached the threshold in what has been counted so far; it is counted from the next scan on,
together with whatever else is active, until each phrase has seen every shard once. So lengths interleave,
and the scans end after the first cycle in which nothing new became active.

Most active phrases come once or twice. So their occurrences are first added up per slot of their hash, in
numbers packed by chunks of slots, and a phrase is counted by its words from the scan on that finds its slot at the
threshold. A slot holds all occurrences of a phrase after one cycle, so no phrase is missed.

Which subphrases have reached the threshold, and which slots, are two filters of bits that only ever grow: a
phrase is due in scan t where the filter of scan t admits it and the filter of scan t - shards does not yet.
That is one whole cycle for every phrase ever admitted, so counts are exact; bits that
several phrases share only admit a few phrases more, which then fail the threshold. Filters and slots are bounded
by ``MOST_BITS``; a corpus that outgrows them has more phrases counted by their words. The bits come to the driver, at most
32 MB a filter, and are broadcast.

A task counts its texts in runs of ``RUN_BYTES`` with one dictionary each; Spark adds the counts up, per task before
the shuffle, so a phrase with a third of all occurrences is one row a run. Phrases that have seen their cycle
leave the running table, those below the threshold for good.

Defined results: a null text is empty and has no words; a null language is ``und``; texts longer than a run are
counted piece by piece; phrases do not cross pieces; repeated rows count as often as they come; equal scores
are ordered by count and then by the bytes of the phrase; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.bits import admitted, with_hashes
from lakemart.llm.common import name_of, stored_at, text_of
from lakemart.session import scratch_path
from lakemart.sources.files import Files

LONGEST = 3
LEAST = 10
SHARDS = 2
TOP = 2000
#: A candidate goes where a longer one around it has at least this percentage of its count.
INSIDE_PERCENT = 50
UNKNOWN = "und"
#: Bits of the filter of phrases that reached the threshold, and at most of the slots'.
FILTER_BITS, MOST_BITS = 2**24, 2**28
#: Slots whose numbers travel together; places in a chunk take 16 bits.
CHUNK = 2**16
RUN_BYTES = 8 * 2**20
#: Slots a task holds before it hands their numbers on.
SLOTS_HELD = 4 * 2**20

#: Small letters for A-Z, one mark between pieces, one blank between words.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
COUNTS = "length int, lang string, phrase string, n long"


def runs_of(langs: list[str], texts: pa.Array) -> Iterator[tuple[str, list[bytes]]]:
    """(language, pieces or texts of about RUN_BYTES) of a batch; marks between pieces are line feeds."""
    order = sorted(range(len(langs)), key=langs.__getitem__)
    run, size, lang = [], 0, None
    for i in order:
        text = texts[i].as_py().translate(PLAIN)
        for part in text.split(b"\n") if len(text) > RUN_BYTES else [text]:
            if run and (langs[i] != lang or size + len(part) > RUN_BYTES):
                yield lang, run
                run, size = [], 0
            lang = langs[i]
            run.append(part)
            size += len(part)
    if run:
        yield lang, run


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    h = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(word, seed) for word in words), np.uint64, len(words))


class Filters(NamedTuple):
    """Bits of the phrases that reached the threshold and of the slots that did, now and a cycle ago."""

    now: np.ndarray
    before: np.ndarray
    slots_now: np.ndarray
    slots_before: np.ndarray


def _slot_admitted(slots: np.ndarray, held: np.ndarray) -> np.ndarray:
    return (held[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


def count_run(
    lang: str, texts: list[bytes], longest: int, words_too: bool, filters: Filters,
) -> Iterator[tuple[int, pa.Array, np.ndarray] | np.ndarray]:
    """(length, phrases, counts) of a run: words if they are due, and longer phrases whose slots are known to be
    full enough; and, as bare arrays, the slots of all that are due by their subphrases."""
    joined = b" \n ".join(text.replace(b"\n", b" \n ") for text in texts)
    whole = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(joined)])), pa.py_buffer(joined))
    coded = pc.split_pattern(whole, " ").flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    codes = coded.indices.to_numpy().astype(np.int64)
    if b"" in words:
        codes = codes[codes != words.index(b"")]
    mark = words.index(b"\n") if b"\n" in words else len(words)
    spoken = codes != mark
    if words_too:
        found = np.bincount(codes[spoken], minlength=len(words))
        at = np.flatnonzero(found)
        yield 1, coded.dictionary.take(pa.array(at)), found[at]
    hashes = _word_hashes(lang, words)
    word, last_slot = hashes[codes], np.uint64(len(filters.slots_now) * 64 - 1)
    phrase, inside_now, inside_before = word, spoken & admitted(hashes, filters.now)[codes], spoken & admitted(hashes, filters.before)[codes]
    for length in range(2, longest + 1):
        # Both subphrases of the phrase that starts here: this one, and the one a word later.
        due_now, due_before = inside_now[:-1] & inside_now[1:], inside_before[:-1] & inside_before[1:]
        if not due_now.any():
            return
        phrase = _mixed(phrase[:-1], word[length - 1:])
        at = np.flatnonzero(due_now)
        slots, known = phrase[at] & last_slot, due_before[at]
        yield slots[~known]
        counted = _slot_admitted(slots, filters.slots_now) & ~(known & _slot_admitted(slots, filters.slots_before))
        first = at[counted]
        if len(first):
            ids = codes[first]
            for step in range(1, length):
                _, start, ids, found = np.unique(ids * (len(words) + 1) + codes[first + step], return_index=True, return_inverse=True, return_counts=True)
            start = first[start]
            parts = [coded.dictionary.take(pa.array(codes[start + step])) for step in range(length)]
            yield length, pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())), found
        if length < longest:
            inside_now, inside_before = due_now, due_before
            for inside, held in ((inside_now, filters.now), (inside_before, filters.before)):
                at = np.flatnonzero(inside)
                inside[at] = admitted(phrase[at], held)


SCANNED = f"{COUNTS}, chunk int, places binary, times binary"


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Stretches of ``values`` as binary items."""
    raw = np.ascontiguousarray(values)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * raw.itemsize).astype(np.int32)), pa.py_buffer(raw.view(np.uint8))])


def _chunked(slots: list[np.ndarray]) -> pa.RecordBatch:
    """How often each slot comes, a row a chunk of slots."""
    slot, times = np.unique(np.concatenate(slots), return_counts=True)
    chunk = (slot // np.uint64(CHUNK)).astype(np.int64)
    first = np.flatnonzero(np.diff(chunk, prepend=-1))
    bounds = np.append(first, len(slot))
    none = lambda kind: pa.nulls(len(first), kind)
    return pa.RecordBatch.from_arrays(
        [none(pa.int32()), none(pa.string()), none(pa.string()), none(pa.int64()), pa.array(chunk[first].astype(np.int32)),
         _binaries((slot % np.uint64(CHUNK)).astype("<u2"), bounds), _binaries(np.minimum(times, 255).astype(np.uint8), bounds)],
        ["length", "lang", "phrase", "n", "chunk", "places", "times"])


def _scan(shard: DataFrame, longest: int, words_too: bool, filters) -> DataFrame:
    """What is due in one shard: counts per run, and numbers of slots. ``filters`` are broadcast."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, held = [], 0
        for batch in batches:
            for lang, texts in runs_of(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                for found in count_run(lang, texts, longest, words_too, filters.value):
                    if isinstance(found, np.ndarray):
                        slots.append(found)
                        held += len(found)
                        continue
                    length, phrases, times = found
                    n = len(times)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, length, np.int32)), pa.array([lang]).take(pa.array(np.zeros(n, np.int64))),
                        phrases.cast(pa.string()), pa.array(times.astype(np.int64)), pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], ["length", "lang", "phrase", "n", "chunk", "places", "times"])
                if held > SLOTS_HELD:
                    yield _chunked(slots)
                    slots, held = [], 0
        if held:
            yield _chunked(slots)

    return shard.select("lang", "text").mapInArrow(count, SCANNED)


def _added(scanned: DataFrame, before: DataFrame | None, least: int) -> DataFrame:
    """chunk, total (a byte a slot, up to ``least``), full (a bit a slot that reached it). Chunks stream through the tasks they are dealt to."""
    most = min(least, 255)
    rows = scanned.where("chunk is not null").select("chunk", "places", "times")
    if before is not None:
        rows = rows.unionByName(before.select("chunk", F.lit(None).cast("binary").alias("places"), F.col("total").alias("times")))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None

        def done() -> pa.RecordBatch:
            full = np.packbits(total >= most, bitorder="little")
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([total.astype(np.uint8).tobytes()]), pa.array([full.tobytes()])], ["chunk", "total", "full"])

        for batch in batches:
            for chunk, places, times in zip(*(batch.column(i) for i in range(3))):
                if chunk.as_py() != current:
                    if current is not None:
                        yield done()
                    current, total = chunk.as_py(), np.zeros(CHUNK, np.int64)
                at = slice(None) if not places.is_valid else np.frombuffer(places.as_py(), "<u2")
                total[at] = np.minimum(total[at] + np.frombuffer(times.as_py(), np.uint8), most)
        if current is not None:
            yield done()

    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk int, total binary, full binary")


def _hashed(reached: DataFrame) -> DataFrame:
    """The hash of each phrase (lang, phrase), as the runs compute it."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _word_hashes(lang, phrase.encode().split(b" "))
                one = words[:1]
                for i in range(1, len(words)):
                    one = _mixed(one, words[i:i + 1])
                found.append(one[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64))], ["hash"])

    return reached.select("lang", "phrase").mapInArrow(hashes, "hash long")


def counted_phrases(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text",
    longest: int = LONGEST, least: int = LEAST, shards: int = SHARDS, filter_bits: int = FILTER_BITS, slots: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(length, lang, phrase, n) of every phrase with ``least`` occurrences or more, and (lang, words) of every language.

    There is about a slot for every eight bytes of text unless ``slots`` says otherwise (a power of two from 2**16 on).
    """
    spark = docs.sparkSession
    dealt, settled, languages = (scratch_path(spark, label) for label in ("phrase-shards", "phrase-counts", "phrase-languages"))
    docs.select(
        F.coalesce(name_of(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of(text_column).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"),
    ).write.partitionBy("shard").parquet(dealt)
    files = Files(spark, dealt)
    if slots is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length(text_of(text_column))), F.lit(0))).first()[0]
        slots = min(MOST_BITS, max(CHUNK, 1 << (size // 8).bit_length()))
    reached, full = [np.zeros(filter_bits // 64, np.uint64)], [np.zeros(slots // 64, np.uint64)]
    grew: list[bool] = []
    open_counts = totals = None
    folders: list[str] = []
    step = 0
    while step < shards or any(grew[-shards:]):
        past = max(0, step - shards)
        filters = spark.sparkContext.broadcast(Filters(reached[step], reached[past], full[step], full[past]))
        made: list[str] = []

        def written(frame: DataFrame, label: str) -> DataFrame:
            back, folder = stored_at(frame, f"{label}-{step}")
            made.append(folder)
            return back

        rows = spark.createDataFrame([], f"{COUNTS}, first int, earlier long") if open_counts is None else open_counts
        scanned = spark.createDataFrame([], SCANNED)
        if files.exists(f"{dealt}/shard={step % shards}"):
            shard = spark.read.schema("lang string, text string").parquet(f"{dealt}/shard={step % shards}")
            scanned = written(_scan(shard, longest, step < shards, filters), "phrase-scan")
        filters.destroy()
        rows = rows.unionByName(scanned.where("chunk is null").select(
            "length", "lang", "phrase", "n",
            # A word is active from the first scan on, wherever it comes first.
            F.when(F.col("length") == 1, 0).otherwise(step).alias("first"), F.lit(0).cast("long").alias("earlier")))
        counts = written(rows.groupBy("length", "lang", "phrase").agg(
            F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("earlier").alias("earlier")), "phrases")
        totals = written(_added(scanned, totals, least), "phrase-slots")
        fresh = counts.where((F.col("length") < longest) & (F.col("n") >= least) & (F.col("earlier") < least))
        reached.append(with_hashes(reached[-1], _hashed(fresh)))
        full.append(full[-1].copy())
        # A bit a slot: at most 32 MB.
        bits = totals.select("chunk", "full").toArrow()
        for chunk, whole in zip(bits["chunk"].to_pylist(), bits["full"].to_pylist()):
            full[-1][chunk * (CHUNK // 64):(chunk + 1) * (CHUNK // 64)] = np.frombuffer(whole, np.uint64)
        grew.append(bool((reached[-1] != reached[-2]).any() or (full[-1] != full[-2]).any()))
        if step >= shards:
            reached[past], full[past] = None, None
        step += 1
        # First seen a cycle ago or earlier: every shard has been counted.
        over = F.col("first") <= step - shards
        if step == shards:
            counts.where("length = 1").groupBy("lang").agg(F.sum("n").alias("words")).write.parquet(languages)
        counts.where(over & (F.col("n") >= least)).select("length", "lang", "phrase", "n").write.mode("append").parquet(settled)
        open_counts = counts.where(~over).withColumn("earlier", F.col("n"))
        # The step's tables replace those of the one before.
        for folder in folders:
            files.delete(folder)
        folders = made
    open_counts.where(F.col("n") >= least).select("length", "lang", "phrase", "n").write.mode("append").parquet(settled)
    for folder in [*folders, dealt]:
        files.delete(folder)
    return spark.read.schema(COUNTS).parquet(settled), spark.read.schema("lang string, words long").parquet(languages)


#: Exact for counts below 10**16: no product has more than 38 digits, and ``div`` keeps whole numbers.
SCORE = """(cast(a as decimal(38,0)) * cast(a as decimal(38,0)) * cast(1000000 as decimal(7,0)))
                  div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))"""


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, length, a, l, r, score of every phrase of two words or more, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = counts.where("length > 1").select(
        "lang", "phrase", "length", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
            "*", _part(words, F.lit(1), F.col("k")).alias("head"), _part(words, F.col("k") + 1, F.col("length") - F.col("k")).alias("tail"))
    known = counts.select("lang", F.col("phrase").alias("part"), "n")
    cuts = cuts.join(known.select("lang", F.col("part").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    lowest = F.min(F.struct(F.expr(SCORE).alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "length", "a").agg(lowest.alias("cut")).select(
        "lang", "phrase", "length", "a", "cut.l", "cut.r", "cut.score")


def maximal(found: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``found`` without phrases that a longer one with enough of their count holds."""
    words = F.split("phrase", " ")
    parts = found.where("length > 2").select(
        "lang", words.alias("words"), "length", F.col("a").alias("around"), F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("size")).select(
            "*", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("at"))
    around = parts.groupBy("lang", _part(F.col("words"), F.col("at"), F.col("size")).alias("phrase")).agg(F.max("around").alias("around"))
    return found.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a"))).drop("around")


def collocations(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", longest: int = LONGEST, least: int = LEAST,
    shards: int = SHARDS, top: int = TOP, inside_percent: int = INSIDE_PERCENT,
) -> DataFrame:
    """Per language the ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    counts, languages = counted_phrases(docs, lang_column, text_column, longest, least, shards)
    # Spark drops what cannot be among the first of a language before it moves the rest.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = maximal(scored(counts), inside_percent).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(languages, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
