"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the split costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

TARGET_SHUFFLE_BYTES = 256 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial shuffle width for a load of ``input_bytes``; AQE coalesces what turns out small."""
    by_size = math.ceil(input_bytes / TARGET_SHUFFLE_BYTES)
    return max(cores, by_size)


def build_session(
    app_name: str, master: str | None = None, conf: dict | None = None, input_bytes: int | None = None
) -> SparkSession:
    """A session with the project's settings.

    ``input_bytes`` is the volume a load shuffles, roughly its landing data plus its window: it sets
    how many partitions a shuffle starts with, which adaptive execution then only reduces.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        widen_shuffles(spark, input_bytes)
    return spark


def widen_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set how many partitions a shuffle of ``input_bytes`` starts with."""
    width = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    return width


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without one gets a fresh temporary folder; a cluster session without one is
    an error, since a machine-local folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    shared = tempfile.mkdtemp(prefix="lakemart-")
    spark.sparkContext.setCheckpointDir(shared)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
