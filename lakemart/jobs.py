"""Mart jobs for spark-submit: one application per mart run.

    spark-submit lakemart/jobs.py ads adset  --root s3a://lake --landing s3a://api/ads/adset --audiences s3a://api/adsets
    spark-submit lakemart/jobs.py ads ad     --root s3a://lake --landing s3a://api/ads/ad --creatives s3a://api/creatives
        --videos s3a://api/videos --posts s3a://api/posts
    spark-submit lakemart/jobs.py window camp --root s3a://lake
    spark-submit lakemart/jobs.py sales      --root s3a://lake --landing s3a://api/sales
    spark-submit lakemart/jobs.py subscriptions --root s3a://lake
    spark-submit lakemart/jobs.py sheet      --root s3a://lake
    spark-submit lakemart/jobs.py maintain   --root s3a://lake

``--landing`` holds the extracted records below ``ingestion_date=<day>``, as JSON lines, or one array
per file with ``--arrays``. The lookup tables of the ads are JSON lines or Parquet files; without one the
dimension keeps the attributes it has. Subscriptions and dropped files are taken from ``<root>/stage``.
``window`` prints the days to extract and their slices. Session settings come from spark-submit,
``spark.checkpoint.dir`` among them; shuffles are sized by what has landed.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lakemart import spec
from lakemart.operators.lookups import resolve_creatives
from lakemart.operators.windows import date_slices, load_window
from lakemart.plans.ads import AdsMart, insight_schema
from lakemart.plans.sales import SalesMart, flatten_sales
from lakemart.plans.snapshots import ProjectionsMart, SheetSalesMart, SubscriptionsMart
from lakemart.plans.upkeep import all_tables, maintain
from lakemart.session import build_session, widen_shuffles
from lakemart.sources.files import Files
from lakemart.sources.landing import raw_partition, read_partition


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one mart job.")
    parser.add_argument("job", choices=["ads", "sales", "subscriptions", "sheet", "projections", "maintain", "window"])
    parser.add_argument("level", nargs="?", choices=[*spec.ADS_LEVELS, "sales"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--landing")
    parser.add_argument("--schema", help="DDL of the subscription records; by default the fields they have")
    for table in spec.ADS_LOOKUPS:
        parser.add_argument(f"--{table}")
    for bound in ("--first", "--last"):
        parser.add_argument(bound, type=dt.date.fromisoformat, help="explicit days of the extraction window")
    parser.add_argument("--arrays", action="store_true")
    parser.add_argument("--date", type=dt.date.fromisoformat, default=None, help="ingestion date, today by default")
    parser.add_argument("--input-bytes", type=int, default=None)
    given = parser.parse_args(argv)
    if given.job in ("ads", "window") and (not given.level or given.job == "ads" and given.level == "sales"):
        parser.error(f"{given.job} needs a level")
    if given.creatives and not (given.videos and given.posts):
        parser.error("--creatives needs --videos and --posts")
    if given.job in ("ads", "sales") and not given.landing:
        parser.error(f"{given.job} needs --landing")
    given.date = given.date or dt.datetime.now(dt.timezone.utc).date()
    return given


def lookup_tables(spark: SparkSession, given: argparse.Namespace) -> dict[str, DataFrame]:
    """The lookup tables of an ads load that were given."""
    def table(name: str) -> DataFrame:
        path = getattr(given, name)
        reader = spark.read.schema(spec.ADS_LOOKUPS[name]).option("mode", "FAILFAST")
        names = [child for child, _ in Files(spark, path).children(path)]
        return reader.parquet(path) if any(child.endswith(".parquet") for child in names) else reader.json(path)

    found = {}
    if given.audiences:
        found["audiences"] = table("audiences")
    if given.creatives:
        found["creatives"] = resolve_creatives(*map(table, ("creatives", "videos", "posts")))
    return found


def landed_bytes(spark: SparkSession, given: argparse.Namespace) -> int:
    """What this run takes in, from the file listing."""
    if given.landing:
        return Files(spark, given.landing).size(raw_partition(given.landing, given.date))
    return Files(spark, given.root).size(f"{given.root}/stage")


def extraction_window(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    """slice_start, slice_end of the days to extract."""
    if given.level == "sales":
        table, days = SalesMart(spark, given.root).bronze, (spec.SALES_LOOKBACK_DAYS, spec.SALES_BACKFILL_DAYS, spec.SALES_SLICE_DAYS)
    else:
        table, days = AdsMart(spark, given.root, given.level).bronze, (spec.ADS_LOOKBACK_DAYS, spec.ADS_BACKFILL_DAYS, spec.ADS_SLICE_DAYS)
    bounds = load_window(table.watermark(), days[0], days[1], given.date, (given.first, given.last))
    return date_slices(spark.createDataFrame([bounds], "first date, last date"), "first", "last", days[2])


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.job != "window" and given.input_bytes is None:
        widen_shuffles(spark, landed_bytes(spark, given))
    if given.job == "ads":
        mart = AdsMart(spark, given.root, given.level)
        schema = insight_schema(mart.level)
        landed = read_partition(spark, given.landing, given.date, schema, arrays=given.arrays)
        mart.load(landed, given.date, **lookup_tables(spark, given))
    elif given.job == "window":
        for row in extraction_window(spark, given).orderBy("slice_start").collect():
            print(row["slice_start"], row["slice_end"])
    elif given.job == "sales":
        records = read_partition(spark, given.landing, given.date, spec.SALES_RECORD_DDL, arrays=given.arrays)
        SalesMart(spark, given.root).load(flatten_sales(records), given.date)
    elif given.job == "subscriptions":
        mart = SubscriptionsMart(spark, given.root)
        mart.to_raw(given.date)
        mart.load(given.date, given.schema, given.arrays)
    elif given.job == "sheet":
        SheetSalesMart(spark, given.root).run(given.date)
    elif given.job == "projections":
        ProjectionsMart(spark, given.root).run(given.date)
    else:
        maintain(all_tables(spark, given.root))


if __name__ == "__main__":
    chosen = arguments()
    run(build_session(f"lakemart-{chosen.job}", input_bytes=chosen.input_bytes), chosen)
