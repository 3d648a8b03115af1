"""Marts that always arrive whole: subscriptions, spreadsheet sales and projections."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakemart import spec
from lakemart.functions.casts import lenient_cast, quoted
from lakemart.functions.nested import flatten_structs
from lakemart.functions.text import currency_decimal, md5_key, month_label_date
from lakemart.operators.dedup import distinct_rows
from lakemart.operators.projection import dates_only, select_present
from lakemart.operators.quality import all_present, exclude_ids, require_snapshot
from lakemart.plans.together import run_together
from lakemart.sources.files import Files, file_listing, staged
from lakemart.sources.landing import (
    ARRIVAL, is_inbox_file, latest_drop_path, promote, raw_partition, read_drop, read_partition,
)
from lakemart.sources.tables import SnapshotTable

WORKBOOKS = [".xlsx"]
PROJECTION_FILES = [".xlsx", ".xls", ".csv"]
_RAW = "_raw"


class SubscriptionsMart:
    """Snapshot of records whose schema is whatever arrives, flattened and passed through."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.stage_root = f"{root}/stage/subscriptions"
        self.raw_root = f"{root}/raw/subscriptions"
        self.bronze = SnapshotTable(spark, f"{root}/bronze/subscriptions/bronze_subscriptions")
        self.silver = SnapshotTable(spark, f"{root}/silver/subscriptions/silver_subscriptions")
        self.fact = SnapshotTable(spark, f"{root}/gold/subscriptions/f_assinaturas")

    def tables(self) -> list:
        return [self.bronze, self.silver, self.fact]

    def to_raw(self, ingestion_date: dt.date) -> int:
        return promote(self.spark, self.stage_root, self.raw_root, ingestion_date, [".json"])

    def load(self, ingestion_date: dt.date, schema: T.StructType | str | None = None, arrays: bool = False) -> None:
        """Load one ingestion date. Without a schema every field that arrives is kept; with one, only its fields."""
        records = read_partition(self.spark, self.raw_root, ingestion_date, schema, arrays=arrays).drop(ARRIVAL)
        if not records.isEmpty():
            self.bronze.overwrite(flatten_structs(records))
        if self.bronze.exists():
            self.silver.overwrite(self.bronze.read())
            self.fact.overwrite(self.silver.read())


def type_sheet(sheet: DataFrame) -> DataFrame:
    """The known sheet columns leniently cast, whatever else the drop holds left as it is."""
    types = {name: spec.sheet_type(name) for name in spec.sheet_columns()}
    return lenient_cast(sheet, types, cut_fractions=True)


def flag_misfits(sheet: DataFrame) -> DataFrame:
    """The typed rows; one that holds a cell its type cannot read has itself as it came in ``_raw``, others null there.

    An empty cell is no misfit. To be written before it is filtered: a filter over the casts of a whole sheet is
    taken apart by the optimizer once for every column that it names.
    """
    known = [name for name in spec.sheet_columns() if name in sheet.columns]
    raw = F.struct(*[F.col(quoted(name)) for name in sheet.columns])
    typed = type_sheet(sheet.withColumn(_RAW, raw))
    misfit = F.lit(False)
    for name in known:
        cell = F.col(_RAW).getField(name).cast("string")
        misfit = misfit | (F.col(quoted(name)).isNull() & (F.coalesce(F.trim(cell), F.lit("")) != ""))
    return typed.withColumn(_RAW, F.when(misfit, F.col(_RAW)))


def split_misfits(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rows as they came that hold a misfit) of written ``flag_misfits``."""
    return flagged.where(F.col(_RAW).isNull()).drop(_RAW), flagged.where(F.col(_RAW).isNotNull()).select(f"{_RAW}.*")


def sheet_silver(sheet: DataFrame) -> DataFrame:
    """Rows with buyer and email, hash keys added, listed sales removed."""
    contacts = all_present(sheet, ["Nome do comprador", "Email do comprador"]).withColumns({
        name: F.col(quoted(name)).cast("string")
        for name in ("Nome do comprador", "Email do comprador", "Nome Afiliado")
    })
    keyed = contacts.withColumns({
        "ID_Cliente": md5_key(F.col("Nome do comprador"), F.col("Email do comprador")),
        "ID_Afiliado": md5_key(F.col("Nome Afiliado")),
    })
    return exclude_ids(keyed, "ID Venda", spec.SHEET_EXCLUDED_IDS)


def sheet_fact(silver: DataFrame) -> DataFrame:
    """Fact columns with day precision. Repeated sale ids are kept as they are."""
    return dates_only(select_present(silver, spec.SHEET_FACT_COLUMNS), spec.SHEET_TIMESTAMPS)


def projection_fact(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        month_label_date(F.col("Mês")).alias("Data"), currency_decimal(F.col("Valor Total")).alias("Valor")
    )


class DroppedFileMart:
    """Files dropped by hand: checked in the inbox, kept in raw, loaded from the newest drop.

    A drop of several files is refused; with ``first_only`` the first by name is loaded and the others are not.
    """

    required: tuple[str, ...] = ()
    optional = False

    def __init__(self, spark: SparkSession, root: str, name: str, extensions, sheet=None, decode=None, first_only=False):
        self.spark = spark
        self.first_only = first_only
        self.inbox = f"{root}/stage/{name}"
        self.raw_root = f"{root}/raw/{name}"
        self.extensions = extensions
        self.sheet = sheet
        self.decode = decode

    def read_file(self, path: str) -> DataFrame:
        return read_drop(self.spark, path, self.sheet, self.decode)

    def arrived(self) -> list[str]:
        """Names of the files waiting in the inbox."""
        listing = file_listing(self.spark, self.inbox)
        found = listing.where(is_inbox_file(F.col("file_name"), self.extensions))
        return sorted(row["file_name"] for row in found.select("file_name").distinct().collect())

    def run(self, ingestion_date: dt.date) -> bool:
        """Ingest and load when something arrived; otherwise skip this branch."""
        if not self.arrived():
            return False
        self.ingest(ingestion_date)
        self.load()
        return True

    def ingest(self, ingestion_date: dt.date) -> int:
        """Check every inbox file, then move them all to raw; one bad file stops them all."""
        names = self.arrived()
        if not names and not self.optional:
            raise FileNotFoundError(f"nothing to ingest in {self.inbox}")
        for name in names:
            require_snapshot(self.read_file(f"{self.inbox}/{name}"), self.required)
        files = Files(self.spark, self.inbox)
        for name in names:
            files.move(f"{self.inbox}/{name}", f"{raw_partition(self.raw_root, ingestion_date)}/{name}")
        return len(names)

    def newest(self) -> DataFrame | None:
        path = latest_drop_path(self.spark, self.raw_root, self.extensions, self.first_only)
        return self.read_file(path) if path else None


class SheetSalesMart(DroppedFileMart):
    required = spec.SHEET_REQUIRED

    def __init__(self, spark: SparkSession, root: str, decode=None, extensions=tuple(WORKBOOKS), first_only=False):
        super().__init__(spark, root, "sheet_sales", extensions, spec.SHEET_NAME, decode, first_only)
        self.bronze = SnapshotTable(spark, f"{root}/bronze/sheet/bronze_vendas")
        self.silver = SnapshotTable(spark, f"{root}/silver/sheet/silver_vendas")
        self.rejects = SnapshotTable(spark, f"{root}/rejects/sheet/vendas")
        self.fact = SnapshotTable(spark, f"{root}/gold/sheet/f_vendas")
        self.dimensions = {
            dim.name: SnapshotTable(spark, f"{root}/gold/sheet/{dim.name}") for dim in spec.SHEET_DIMENSIONS
        }

    def tables(self) -> list:
        return [self.bronze, self.rejects, self.silver, self.fact, *self.dimensions.values()]

    def load(self) -> None:
        """Newest drop to bronze, silver, fact and dimensions; every table is replaced.

        Bronze holds the drop as it came. Rows with an unreadable cell go to the rejects table instead of silver.
        """
        drop = self.newest()
        if drop is None:
            raise FileNotFoundError(f"no sales drop below {self.raw_root}")
        self.bronze.overwrite(drop)
        with staged(flag_misfits(self.bronze.read())) as flagged:
            rows, misfits = split_misfits(flagged)
            run_together([partial(self.rejects.overwrite, misfits), partial(self.silver.overwrite, sheet_silver(rows))])
        silver = self.silver.read()
        gold = {self.fact: sheet_fact(silver)}
        for dim in spec.SHEET_DIMENSIONS:
            rows = distinct_rows(silver, dim.columns)
            if rows.columns:
                gold[self.dimensions[dim.name]] = rows
        run_together([partial(table.overwrite, rows) for table, rows in gold.items()])


class ProjectionsMart(DroppedFileMart):
    """Optional branch: without a drop nothing happens."""

    optional = True

    def __init__(self, spark: SparkSession, root: str, decode=None, first_only=False):
        super().__init__(spark, root, "projections", PROJECTION_FILES, None, decode, first_only)
        self.bronze = SnapshotTable(spark, f"{root}/bronze/sheet/bronze_projetadas")
        self.fact = SnapshotTable(spark, f"{root}/gold/sheet/projetadas")

    def tables(self) -> list:
        return [self.bronze, self.fact]

    def load(self) -> None:
        drop = self.newest()
        if drop is not None:
            self.bronze.overwrite(drop)
        if self.bronze.exists():
            self.fact.overwrite(projection_fact(self.bronze.read()))
