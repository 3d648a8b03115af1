"""Language identification by fusing evidence with Bayes' rule.

    posterior(l) ~ text likelihood(l) x declared language(l) x address suffix(l) x prior(l)

Text: hashed byte trigrams under a naive Bayes model, with one more class, ``und``, that expects every
trigram alike and so takes texts that are in none of the languages. Trigrams overlap, hence a third of
each log likelihood counts. Declared language (an html lang attribute, a metadata field) and suffix
(a country domain) are right with a given reliability and silent where absent. The prior of a host is
smoothed towards its domain's, that one towards its suffix's and at last towards the corpus': the counts
are sums of text posteriors by host, domain and suffix, grouped aggregations over all rows. A row's own
share is taken out of the counts first, so that its text does not count twice.

The model is fitted on a sample: of each declared language about ``FIT_ROWS`` rows, chosen by a hash of
the id. Every declared language of ``FEWEST_ROWS`` rows or more is fitted, at 128 KB of the model each.
The others have no trigrams to go by. They stay in a written table, and their text likelihood is that of
``und``: where a row declares one of them, the declaration speaks for the texts in no fitted language, the
host prior of ``und`` counts for it, and the row gets that language with the declaration's reliability.
Everything else covers all rows.

Defined results: a null text is the empty text; a very long text is counted in slices, whole; a text without letters has no text evidence and is
decided by the rest; null hosts form a host; rows that repeat are decided alike; an empty table, or one
without any declared language, knows the language ``und`` alone; other columns are ignored by
``identify`` and carried by ``keep_identified``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import apply_verdicts, name_of, stored, stored_at, text_of

UNDETERMINED = "und"
BUCKETS = 2**15
FIT_ROWS = 2000
#: Declared languages with fewer rows than this are not fitted; declarations decide them.
FEWEST_ROWS = 5
SMOOTHING = 0.05
#: Overlapping trigrams count every byte three times.
TEXT_WEIGHT = 1 / 3
DECLARED_RELIABILITY = 0.9
SUFFIX_RELIABILITY = 0.8
#: Rows of the coarser level that a finer level's counts are smoothed with.
PRIOR_STRENGTH = 10.0
LEAST_CONFIDENCE = 0.5

# Country suffix -> language.
SUFFIXES = {
    "at": "de", "br": "pt", "cz": "cs", "de": "de", "dk": "da", "es": "es", "fi": "fi", "fr": "fr", "gr": "el", "hu": "hu",
    "ie": "en", "it": "it", "jp": "ja", "kr": "ko", "mx": "es", "nl": "nl", "pl": "pl", "pt": "pt", "ro": "ro", "ru": "ru",
    "se": "sv", "tr": "tr", "uk": "en", "us": "en",
}

_LETTERS = bytes(code if 97 <= code <= 122 or code >= 128 else 32 for code in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of the text's words, small letters alone, one blank around each word."""
    words = (text or "").lower().encode().translate(_LETTERS).split()
    if not words:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages, the last of them ``und``, and the log probability of every bucket in each.

    ``rare`` is the folder of the declared languages with too few rows to be fitted, if there are any.
    """

    languages: tuple[str, ...]
    log_probability: np.ndarray
    rare: str | None = None

    def log_likelihood(self, text: str | None) -> np.ndarray:
        found = trigrams(text)
        total = np.zeros(len(self.languages))
        # In slices: a very long text needs no more memory than a short one.
        for at in range(0, len(found), 2**16):
            total += self.log_probability[found[at:at + 2**16]].sum(axis=0, dtype=np.float64)
        return total


def primary(language: Column) -> Column:
    """``en`` of ``en-US``; null for an empty declaration."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(language)), r"^[a-z]+", 0), F.lit(""))


def fit(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
        fit_rows: int = FIT_ROWS) -> Model:
    """A model of all declared languages, from at most about ``fit_rows`` rows of each."""
    labelled = rows.select(name_of(id_column).alias("id"), text_of(text_column).alias("text"),
                           primary(name_of(language_column).cast("string")).alias("language")).where("language is not null")
    counted, path = stored_at(labelled.where(F.col("language") != UNDETERMINED).groupBy("language").count(), "language-counts")
    counts = counted.where(F.col("count") >= FEWEST_ROWS).collect()
    rare = None if counted.where(F.col("count") < FEWEST_ROWS).isEmpty() else path
    languages = sorted(row["language"] for row in counts)
    number = {language: i for i, language in enumerate(languages)}
    # One language at a time: no second matrix of all of them in double precision.
    log_probability = np.full((BUCKETS, len(languages) + 1), -math.log(BUCKETS), np.float32)
    if languages:
        share = F.create_map(*[F.lit(x) for row in counts for x in (row["language"], min(1.0, fit_rows / row["count"]))])
        drawn = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(2**20)) / 2**20
        sample = labelled.where(drawn < F.try_element_at(share, F.col("language"))).repartition(8, "id")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stated = np.array([number[language.as_py()] for language in batch.column(1)], np.int64)
                for language in np.unique(stated):
                    found = np.zeros(BUCKETS, np.int64)
                    for row in np.flatnonzero(stated == language):
                        found += np.bincount(trigrams(batch.column(0)[int(row)].as_py()), minlength=BUCKETS)
                    bucket = np.flatnonzero(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(bucket), language)), pa.array(bucket), pa.array(found[bucket])], ["language", "bucket", "n"])

        counted = sample.select("text", "language").mapInArrow(count, "language long, bucket long, n long")
        # At most BUCKETS rows of each language, whatever the corpus holds and however it is dealt out.
        summed = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
        which, bucket, n = (summed[name].to_numpy() for name in ("language", "bucket", "n"))
        order = np.argsort(which, kind="stable")
        ends = np.searchsorted(which[order], np.arange(len(languages) + 1))
        for i in range(len(languages)):
            own = order[ends[i]:ends[i + 1]]
            smoothed = np.full(BUCKETS, SMOOTHING)
            smoothed[bucket[own]] += n[own]
            log_probability[:, i] = np.log(smoothed / smoothed.sum())
    return Model((*languages, UNDETERMINED), log_probability, rare)


def _with_rare(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` and ``rare``: the declared language where it is one of those that were not fitted, else null."""
    if model.rare is None:
        return rows.withColumn("rare", F.lit(None).cast("string"))
    # Rows that cannot declare one are not joined, so neither nulls nor frequent languages are a hot key.
    known = F.col("declared").isNull() | F.col("declared").isin(*model.languages)
    listed = rows.sparkSession.read.schema("language string, count long").parquet(model.rare).where(F.col("count") < FEWEST_ROWS)
    listed = listed.select(F.col("language").alias("rare"))
    joined = rows.where(~known).join(listed, F.col("declared") == F.col("rare"), "left")
    return rows.where(known).withColumn("rare", F.lit(None).cast("string")).unionByName(joined)


def _softmax(scores: Column) -> Column:
    raised = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda total, y: total + y))


def _reported(named: Column, model: Model, reliability: float) -> Column:
    """Log likelihood of each language given that ``named`` was stated; zeros where nothing known was."""
    others = max(1, len(model.languages) - 1)
    right, wrong = F.lit(math.log(reliability)), F.lit(math.log((1 - reliability) / others))
    stated = F.array(*[F.when(named == language, right).otherwise(wrong) for language in model.languages])
    return F.when(named.isin(*model.languages), stated).otherwise(F.array(*[F.lit(0.0)] * len(model.languages)))


def _added(*scores: Column) -> Column:
    total = scores[0]
    for score in scores[1:]:
        total = F.zip_with(total, score, lambda x, y: x + y)
    return total


def identify(
    rows: DataFrame, model: Model, id_column: str = "doc_id", text_column: str | Column = "text", declared: Column | None = None,
    suffix: Column | None = None, levels: Sequence[Column] = (), least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """Per row: id, text_hash, language, confidence, text_language, kept.

    ``levels`` name the groups of the prior from coarse to fine, for a web page suffix, domain and host.
    A row is kept where its language is not ``und`` and has the least confidence or more.
    """
    size = len(model.languages)
    text = text_of(text_column) if isinstance(text_column, str) else F.coalesce(text_column, F.lit(""))
    nothing = F.lit(None).cast("string")
    facts = rows.select(
        name_of(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"),
        primary(declared if declared is not None else nothing).alias("declared"),
        (suffix if suffix is not None else nothing).alias("suffix"),
        *[level.cast("string").alias(f"level_{i}") for i, level in enumerate(levels)])
    names = [name for name in facts.columns if name != "text"]
    kind = facts.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likely = [model.log_likelihood(text.as_py()) for text in batch.column(batch.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(name)) for name in names] + [pa.array(likely, pa.list_(pa.float64()))],
                [*names, "likely"])

    kinds = {"id": kind, "text_hash": "long"}
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in names)
    weighed = facts.mapInArrow(score, f"{schema}, likely array<double>").withColumn(
        "likely", F.transform("likely", lambda x: x * TEXT_WEIGHT))
    scored = stored(weighed.withColumn("share", _softmax(F.col("likely"))), "language-text")

    def sums(frame, *keys):
        return frame.groupBy(*keys).agg(F.array(*[F.coalesce(F.sum(F.col("share")[i]), F.lit(0.0)) for i in range(size)]).alias("sums"))

    def smoothed(counts: Column, prior: Column) -> Column:
        # The row's own share leaves the counts; rounding must not leave a negative rest.
        others = F.zip_with(counts, F.col("share"), lambda n, own: F.greatest(n - own, F.lit(0.0)))
        shares = F.zip_with(others, prior, lambda n, p: n + PRIOR_STRENGTH * p)
        whole = F.aggregate(counts, F.lit(PRIOR_STRENGTH - 1.0), lambda total, n: total + n)
        return F.transform(shares, lambda x: x / whole)

    # One row for the whole corpus, so this join is with a single row.
    corpus = sums(scored).withColumnRenamed("sums", "corpus")
    judged = _with_rare(scored, model).join(F.broadcast(corpus)).withColumn(
        "prior", smoothed(F.col("corpus"), F.array(*[F.lit(1.0 / size)] * size))).drop("corpus")
    for i in range(len(levels)):
        key = f"level_{i}"
        counts = sums(scored, key).withColumnsRenamed({key: "known", "sums": "counts"})
        judged = judged.join(counts, judged[key].eqNullSafe(counts["known"])).withColumn(
            "prior", smoothed(F.col("counts"), F.col("prior"))).drop("counts", "known")
    scores = _added(
        F.col("likely"), F.transform("prior", lambda p: F.log(p)),
        # A language that was not fitted is among what und stands for.
        _reported(F.when(F.col("rare").isNotNull(), UNDETERMINED).otherwise(F.col("declared")), model, DECLARED_RELIABILITY),
        _reported(F.element_at(F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair]), F.col("suffix")),
                  model, SUFFIX_RELIABILITY))
    # Written here: the posterior names its scores many times, and each would hold the whole expression.
    judged = stored(judged.select("id", "text_hash", "rare", "share", scores.alias("scores")), "language-scores")
    judged = stored(judged.select("id", "text_hash", "rare", "share", _softmax(F.col("scores")).alias("posterior")), "language-posteriors")
    known = F.array(*map(F.lit, model.languages))

    def best(scores: str) -> Column:
        return F.element_at(known, F.array_position(F.col(scores), F.array_max(scores)).cast("int"))

    named = (best("posterior") == UNDETERMINED) & F.col("rare").isNotNull()
    language = F.when(named, F.col("rare")).otherwise(best("posterior"))
    confidence = F.array_max("posterior") * F.when(named, DECLARED_RELIABILITY).otherwise(1.0)
    return judged.select(
        "id", "text_hash", language.alias("language"), confidence.alias("confidence"), best("share").alias("text_language"),
        ((language != UNDETERMINED) & (confidence >= least_confidence)).alias("kept"))


def keep_identified(docs: DataFrame, decisions: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language was identified, with all their columns."""
    verdicts = decisions.select("id", F.col("text_hash").alias("mark"), "kept")
    return apply_verdicts(docs, verdicts, id_column, F.xxhash64(text_of(text_column)), once=False)


def page_text(html: Column) -> Column:
    """What a page shows: its markup, scripts, styles and comments as blanks."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")


def page_language(html: Column) -> Column:
    """The language that the page's html element declares, or null."""
    return F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z-]+)""", 1)


def host_levels(url: Column) -> tuple[Column, Column, Column]:
    """(suffix, domain, host) of an address."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    labels = F.split(host, r"\.")
    return F.substring_index(host, ".", -1), F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."), host
