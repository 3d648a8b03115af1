"""Left lookups, the star join and creative resolution.

No broadcast hint anywhere: a lookup side is broadcast only when its estimated (or, with adaptive
execution, measured) size is below the session threshold; otherwise it is a sort-merge join whose
hot partitions adaptive execution splits. Rows without a key match nothing and can be most of the
input, so they are spread over the shuffle instead of meeting in one partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from lakemart.functions.casts import quoted
from lakemart.functions.links import WATCH, click_url, video_url
from lakemart.functions.nested import creative_post_id, creative_video_id, thumbnail_url
from lakemart.operators.dedup import keep_last


NULL_KEY_SPREAD = 4096
_SPREAD = "_spread"


def one_per_key(table: DataFrame, on: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, by default all its other columns."""
    rest = [name for name in table.columns if name not in on]
    return keep_last(table, on, [*(order_by or rest)]) if rest else table.select(*map(quoted, on)).distinct()


def left_join(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi join that keeps every row once: ``table`` is reduced to one row per key first.

    Rows with a null key match nothing and are spread by their position, which reads no column. The extra
    join column is 0 for every row that can match. It is computed from the key on the table side too,
    since Catalyst would fold a literal away and shuffle by the key alone.
    """
    def lacking(keys):
        return reduce(or_, [F.col(quoted(name)).isNull() for name in keys])

    bucket = F.pmod(F.monotonically_increasing_id(), F.lit(NULL_KEY_SPREAD))
    rows = df.withColumn(_SPREAD, F.when(lacking(on), bucket + 1).otherwise(0))
    matches = one_per_key(table, on).withColumn(_SPREAD, F.when(lacking(on), -1).otherwise(0).cast("bigint"))
    return rows.join(matches, [*on, _SPREAD], "left").drop(_SPREAD)


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Add the ``defaults`` columns of ``table``, defaulting where there is no match."""
    wanted = table.select(*[F.col(quoted(name)) for name in [*on, *defaults]])
    joined = left_join(df, wanted, on)
    return joined.withColumns({
        name: F.coalesce(F.col(quoted(name)), F.lit(value)) for name, value in defaults.items()
    }).select(*[F.col(quoted(name)) for name in [*df.columns, *defaults]])


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Fact rows with the attributes of each dimension, unmatched ones null."""
    return reduce(lambda rows, dim: left_join(rows, *dim), dimensions, fact)


def resolve_creatives(
    creatives: DataFrame, videos: DataFrame, posts: DataFrame
) -> DataFrame:
    """``ad_id`` with video url, click url and thumbnail: video first, else post, else empty.

    ``creatives`` has ``ad_id`` and ``creative``; ``videos`` has ``id, permalink_url, picture,
    thumbnails``; ``posts`` has ``id, permalink_url, full_picture``. Ids that repeat count once, with
    their greatest values.
    """
    picked = one_per_key(creatives, ["ad_id"]).select(
        "ad_id",
        creative_video_id(F.col("creative")).alias("video_id"),
        creative_post_id(F.col("creative")).alias("post_id"),
    ).withColumn("post_id", F.when(F.col("video_id").isNull(), F.col("post_id")))
    video_meta = videos.select(
        F.col("id").alias("video_id"),
        F.nullif("permalink_url", F.lit("")).alias("video_link"),
        thumbnail_url(F.col("picture"), F.col("thumbnails")).alias("video_thumb"),
    )
    post_meta = posts.select(
        F.col("id").alias("post_id"),
        F.nullif("permalink_url", F.lit("")).alias("post_link"),
        F.col("full_picture").alias("post_thumb"),
    )
    met = left_join(left_join(picked, video_meta, ["video_id"]), post_meta, ["post_id"])
    from_video = F.col("video_id").isNotNull()
    link = (
        F.when(from_video, video_url(
            F.coalesce(F.col("video_link"), F.concat(F.lit(WATCH), F.col("video_id")))
        ))
        .when(F.col("post_id").isNotNull(), F.coalesce(F.col("post_link"), video_url(F.col("post_id"))))
        .otherwise(F.lit(""))
    )
    return met.withColumn("video_url", link).select(
        "ad_id",
        "video_url",
        click_url(F.col("video_url")).alias("video_url_click"),
        F.coalesce(F.when(from_video, F.col("video_thumb")).otherwise(F.col("post_thumb")), F.lit(""))
        .alias("video_thumbnail_url"),
    )
