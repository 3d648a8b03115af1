"""Ads mart: restated daily metrics per campaign, ad set and ad."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakemart import spec
from lakemart.functions.casts import iso_date, lenient_cast
from lakemart.functions.nested import action_count, action_value, audience_label
from lakemart.operators.dedup import keep_last
from lakemart.operators.lookups import lookup
from lakemart.operators.projection import fill_defaults, select_present
from lakemart.operators.quality import any_positive, counted_keys, require_keys, split_rejects
from lakemart.operators.upsert import dimension_rows
from lakemart.sources.files import Files
from lakemart.sources.landing import ARRIVAL, promote, read_partition, stage_by_day
from lakemart.sources.tables import BucketedTable, PartitionedTable

STAGE_DAY = "event_date"
# Records are staged and kept in raw as Parquet; JSON is parsed once, where the extraction drops it.
RAW_FORMAT = "parquet"
MEASURE_TYPES = {
    **{name: T.DoubleType() for name in spec.ADS_AMOUNTS},
    **{name: T.LongType() for name in spec.ADS_COUNTS},
}


def insight_schema(level: spec.AdsLevel) -> T.StructType:
    """Landing record: every scalar as text, since the API mixes numbers and quoted numbers."""
    names = [*level.ids, *(c for c in level.dimension.columns if c.endswith("_name")), "date_start", "date_stop"]
    fields = [T.StructField(name, T.StringType()) for name in [*names, *spec.ADS_DEFAULTS]]
    return T.StructType([*fields, T.StructField("actions", spec.ACTIONS_TYPE)])


def active_insights(records: DataFrame) -> DataFrame:
    """Landing records with defaults and derived measures; idle ones dropped."""
    actions = F.col("actions")
    measured = fill_defaults(records, spec.ADS_DEFAULTS).withColumns({
        "leads": action_count(actions, spec.LEAD_ACTION),
        "purchases": action_count(actions, spec.PURCHASE_ACTION),
        "purchase_value": action_value(actions, spec.PURCHASE_VALUE_ACTION),
    }).drop("actions")
    return any_positive(measured, spec.ADS_ACTIVITY_AMOUNTS, spec.ADS_ACTIVITY_COUNTS)


def with_attributes(
    level: spec.AdsLevel,
    insights: DataFrame,
    audiences: DataFrame | None = None,
    creatives: DataFrame | None = None,
) -> DataFrame:
    """Add the looked-up attributes of the level.

    Empty text means looked up without a match, null not looked up: without a table the attributes are
    null, and the dimension keeps what it has. ``audiences`` has ``id, targeting``; ``creatives`` has
    ``ad_id`` and the video columns.
    """
    if audiences is not None:
        labels = audiences.select(
            F.col("id").alias("adset_id"), audience_label(F.col("targeting")).alias(spec.AUDIENCES)
        )
        insights = lookup(insights, labels, ["adset_id"], {spec.AUDIENCES: ""})
    if creatives is not None:
        insights = lookup(insights, creatives, ["ad_id"], dict.fromkeys(spec.VIDEO_COLUMNS, ""))
    return insights.withColumns({
        name: F.lit(None).cast("string") for name in looked_up(level) if name not in insights.columns
    })


def looked_up(level: spec.AdsLevel) -> list[str]:
    """Attributes of the level's dimension that come from a lookup table."""
    return [name for name in level.dimension.columns if name in (spec.AUDIENCES, *spec.VIDEO_COLUMNS)]


def type_insights(raw: DataFrame, ids: tuple[str, ...]) -> DataFrame:
    """Raw rows with the day as a date, measures as numbers and ids as text."""
    dated = raw.withColumn("data", iso_date(F.col("date_start").cast("string")))
    return lenient_cast(dated, {**MEASURE_TYPES, **{name: T.StringType() for name in ids}})


class AdsMart:
    """One level of the ads mart below ``root``; every hop reads its window from its own target."""

    def __init__(self, spark: SparkSession, root: str, level: str):
        self.spark = spark
        self.level = spec.ADS_LEVELS[level]
        self.stage_root = f"{root}/stage/ads/{level}"
        self.raw_root = f"{root}/raw/ads/{level}"
        self.rejects_root = f"{root}/rejects/ads/{level}"
        self.bronze = PartitionedTable(spark, f"{root}/bronze/ads/bronze_{level}", "data")
        self.silver = PartitionedTable(spark, f"{root}/silver/ads/silver_{level}", "data")
        self.fact = PartitionedTable(spark, f"{root}/gold/ads/f_{level}", "data")
        self.dimension = BucketedTable(spark, f"{root}/gold/ads/{self.level.dimension.name}", self.level.dimension.key)

    def tables(self) -> list:
        return [self.bronze, self.silver, self.fact, self.dimension]

    def stage(self, records: DataFrame, **tables: DataFrame) -> DataFrame:
        """Write the active records, one folder per event day; refuses records without an id.

        Records whose day is none share one folder, however many spellings there are.
        They are counted while they are written, so the landing files are parsed once; a refused load empties the stage
        again. Records that carry their arrival position are reduced to the last per day and id. ``tables`` are those
        of ``with_attributes``.
        """
        insights, gate = counted_keys(active_insights(records), self.level.id_column)
        active = insights
        if ARRIVAL in insights.columns:
            insights = keep_last(insights, ["date_start", self.level.id_column], [ARRIVAL]).drop(ARRIVAL)
        shaped = with_attributes(self.level, insights, **tables)
        day = F.coalesce(iso_date(F.col("date_start")).cast("string"), F.lit(""))
        stage_by_day(shaped.withColumn(STAGE_DAY, day), self.stage_root, STAGE_DAY, RAW_FORMAT)
        if gate.get["missing"]:
            Files(self.spark, self.stage_root).delete(self.stage_root)
            # Only now are the records read again, for the days to be named.
            require_keys(active, "date_start", self.level.id_column)
        return shaped

    def to_raw(self, ingestion_date: dt.date) -> int:
        return promote(self.spark, self.stage_root, self.raw_root, ingestion_date, ["." + RAW_FORMAT])

    def read_raw(self, ingestion_date: dt.date, shaped_schema: T.StructType) -> DataFrame:
        return read_partition(self.spark, self.raw_root, ingestion_date, shaped_schema, RAW_FORMAT)

    def to_bronze(self, raw: DataFrame, ingestion_date: dt.date) -> None:
        """Merge one ingestion date; rows without day or id go to the rejects folder instead.

        Where all rows are rejects the table stays as it is, or absent.
        """
        folder = f"{self.rejects_root}/ingestion_date={ingestion_date.isoformat()}"
        rows, rejects = split_rejects(type_insights(raw, self.level.ids), self.level.grain)
        if not rejects.isEmpty():
            rejects.drop(ARRIVAL).write.mode("overwrite").parquet(folder)
        self.bronze.merge(keep_last(rows, self.level.grain, [ARRIVAL]).drop(ARRIVAL), self.level.grain, unique=True)

    def to_silver(self) -> None:
        """Merge the bronze window. Bronze holds one row per grain, so there is nothing to dedup."""
        if not self.bronze.exists():
            return
        rows = self.bronze.window(self.silver.window_start(spec.ADS_LOOKBACK_DAYS))
        self.silver.merge(rows, self.level.grain, computed=False, unique=True)

    def to_gold(self) -> None:
        """Merge the dimension, then reload the fact window.

        The fact's watermark sets the next window, so it moves only once the dimension is published.
        """
        if not self.silver.exists():
            return
        start = self.fact.window_start(spec.ADS_LOOKBACK_DAYS)
        rows = self.silver.window(start)
        if rows.isEmpty():
            return
        dim = self.level.dimension
        self.dimension.merge(dimension_rows(rows, dim.key, dim.columns, ["data"]), dim.key, looked_up(self.level), unique=True)
        self.fact.reload_window(select_present(rows, self.level.fact_columns), start, computed=False)

    def load(self, records: DataFrame, ingestion_date: dt.date, **tables: DataFrame) -> None:
        """One whole run, from landing records to gold."""
        shaped = self.stage(records, **tables)
        self.to_raw(ingestion_date)
        self.to_bronze(self.read_raw(ingestion_date, shaped.schema), ingestion_date)
        self.to_silver()
        self.to_gold()
