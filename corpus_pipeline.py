"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run`` writes its
result as Parquet to the shared scratch folder and rereads it as the next one's ``docs``.

Defined results of every stage: a null or empty text is a document without words, a very long one is read whole; rows
that repeat, null ids, sources and languages are handled as each stage says; an empty table gives no rows; columns beyond
those a stage reads are carried along, whatever their names, but by the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm import exact, langid, minhash, mixing, packing
from lakemart.llm.common import let_workers_import, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go.

    A text without letters is decided by its declared language and its source; one without any of them goes. A null
    source is a source. Rows that repeat id and text are kept or go together; an empty table knows no language.
    """
    let_workers_import(spark)
    decided = langid.identify(docs, langid.fit(docs), declared=F.col("lang"), levels=[F.col("source")])
    return langid.keep_identified(docs, decided)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the one with the smallest doc_id.

    Empty and null texts are equal; a null id counts as larger than every id; of rows that repeat id and text one stays.
    """
    return exact.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five-word shingles, similarity 0.8) stays.

    Texts without words are linked with nothing and stay; a null id counts as larger than every id; of rows that
    repeat id and text one stays.
    """
    let_workers_import(spark)
    return minhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it; some sources repeat, others thin out.

    A null source is the last one; documents without words come as often as their source is repeated whole, at most twice;
    equal keys are ordered by id and size; rows that repeat an id share the decision.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return mixing.apply_mix(docs, mixing.mixed(docs, mixing.label_weights(labels)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document row and their places in the sequences.

    A document without words is one piece with the end id alone; every row is a document of its own; null ids are carried.
    """
    let_workers_import(spark)
    pieces = packing.pieces_of(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(pieces).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("source mix", mix),
    ("best-fit packing", pack),
]

# SQL expresses neither the classifier nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
