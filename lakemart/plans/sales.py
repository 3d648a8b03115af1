"""Sales mart: transactions whose status keeps changing."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakemart import spec
from lakemart.functions.casts import epoch_ms_date, lenient_cast
from lakemart.functions.nested import flatten_record
from lakemart.operators.dedup import keep_last, keep_last_of_scan
from lakemart.operators.projection import epoch_columns_to_dates, net_amount, select_present
from lakemart.operators.quality import all_present
from lakemart.operators.upsert import dimension_rows
from lakemart.plans.together import run_together
from lakemart.sources.files import staged
from lakemart.sources.landing import ARRIVAL, promote, read_partition, stage_by_day
from lakemart.sources.tables import BucketedTable, KeyMonths, PartitionedTable

STAGE_DAY = "event_date"
# Records are staged and kept in raw as Parquet; JSON is parsed once, where the extraction drops it.
RAW_FORMAT = "parquet"
SALES_TYPES = {
    **{name: T.DoubleType() for name in spec.SALES_DOUBLES},
    **{name: T.LongType() for name in spec.SALES_LONGS},
    **{name: T.StringType() for name in spec.SALES_TEXTS},
    "is_subscription": T.BooleanType(),
}


def flatten_sales(records: DataFrame) -> DataFrame:
    """Nested sale records as 26 flat columns, with the arrival position where there is one."""
    arrival = {ARRIVAL: ARRIVAL} if ARRIVAL in records.columns else {}
    return flatten_record(records, {**spec.SALES_PATHS, **arrival})


def type_sales(raw: DataFrame) -> DataFrame:
    """Epoch columns as dates, the rest leniently cast."""
    return lenient_cast(epoch_columns_to_dates(raw, spec.SALES_DATES), SALES_TYPES, cut_fractions=True)


def sales_fact(rows: DataFrame) -> DataFrame:
    return net_amount(select_present(rows, spec.SALES_FACT_COLUMNS), "price_value", "fee_total", spec.NET_AMOUNT)


class SalesMart:
    """Bronze, silver and the fact are upserted by transaction and kept by month of the order day."""

    def __init__(self, spark: SparkSession, root: str, lookback_days: int = spec.SALES_LOOKBACK_DAYS):
        self.spark = spark
        self.lookback_days = lookback_days
        self.stage_root = f"{root}/stage/sales"
        self.raw_root = f"{root}/raw/sales"
        # The months of a transaction, learnt on the way into bronze and looked up on all three hops.
        self.months = KeyMonths(spark, f"{root}/bronze/sales/bronze_sales_months", spec.SALES_GRAIN)
        self.bronze = PartitionedTable(spark, f"{root}/bronze/sales/bronze_sales", "data", by_month=True, index=self.months)
        self.silver = PartitionedTable(spark, f"{root}/silver/sales/silver_sales", "data", by_month=True, index=self.months)
        self.fact = PartitionedTable(spark, f"{root}/gold/sales/f_vendas", "data", by_month=True, index=self.months)
        self.dimensions = {
            dim.name: BucketedTable(spark, f"{root}/gold/sales/{dim.name}", dim.key, unique=True) for dim in spec.SALES_DIMENSIONS
        }

    def tables(self) -> list:
        return [self.months, self.bronze, self.silver, self.fact, *self.dimensions.values()]

    def stage(self, flat: DataFrame) -> None:
        """Write flat records by UTC order day; records without transaction or day are dropped.

        Empty text and epoch 0 count as absent. Records that carry their arrival position are
        reduced to the last per transaction first.
        """
        known = flat.withColumns({
            "transaction": F.nullif("transaction", F.lit("")), "order_date_ms": F.nullif("order_date_ms", F.lit(0)),
        })
        complete = all_present(known, ["transaction"])
        if ARRIVAL in flat.columns:
            complete = keep_last(complete, spec.SALES_GRAIN, [ARRIVAL]).drop(ARRIVAL)
        complete = all_present(complete, ["order_date_ms"])
        stage_by_day(complete.withColumn(STAGE_DAY, epoch_ms_date(F.col("order_date_ms"))), self.stage_root, STAGE_DAY, RAW_FORMAT)

    def to_raw(self, ingestion_date: dt.date) -> int:
        return promote(self.spark, self.stage_root, self.raw_root, ingestion_date, ["." + RAW_FORMAT])

    def read_raw(self, ingestion_date: dt.date, flat_schema: T.StructType) -> DataFrame:
        return read_partition(self.spark, self.raw_root, ingestion_date, flat_schema, RAW_FORMAT)

    def to_bronze(self, raw: DataFrame) -> None:
        if not raw.isEmpty():
            with staged(keep_last_of_scan(type_sales(raw), spec.SALES_GRAIN, [ARRIVAL]).drop(ARRIVAL)) as last:
                self.months.learn(last, self.bronze.month(F.col("data")), unique=True)
                self.bronze.merge(last, spec.SALES_GRAIN, computed=False, unique=True)

    def to_silver(self) -> None:
        if not self.bronze.exists():
            return
        # Bronze holds one row per transaction.
        window = self.bronze.window(self.silver.window_start(self.lookback_days))
        self.silver.merge(window, spec.SALES_GRAIN, computed=False, unique=True, laid_out=True)

    def to_gold(self) -> None:
        if not self.silver.exists():
            return
        rows = self.silver.window(self.fact.window_start(self.lookback_days))
        if rows.isEmpty():
            return

        def publish(dim: spec.Dimension) -> None:
            self.dimensions[dim.name].merge(dimension_rows(rows, dim.key, dim.columns, ["data"]), dim.key)

        # The fact's watermark sets the next window, so it moves only once the dimensions are published.
        run_together([partial(publish, dim) for dim in spec.SALES_DIMENSIONS])
        self.fact.merge(sales_fact(rows), spec.SALES_GRAIN, computed=False, unique=True, laid_out=True)

    def load(self, flat: DataFrame, ingestion_date: dt.date) -> None:
        """One whole run, from flat records to gold."""
        self.stage(flat)
        self.to_raw(ingestion_date)
        self.to_bronze(self.read_raw(ingestion_date, flat.drop(ARRIVAL).schema))
        self.to_silver()
        self.to_gold()
