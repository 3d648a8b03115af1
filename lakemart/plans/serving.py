"""Serving: gold tables under declared types, as session views or as catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart import spec
from lakemart.operators.projection import typed_as

# Columns the serving layer narrows to INT.
NARROWED = ("installments_number", "fee_percentage")


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def ads_fact_ddl(level: spec.AdsLevel) -> str:
    columns = dict.fromkeys(level.ids, "string")
    columns |= dict.fromkeys(spec.ADS_AMOUNTS, "double")
    columns |= dict.fromkeys(spec.ADS_COUNTS, "bigint")
    return _ddl({**columns, "data": "date"})


def sales_fact_ddl() -> str:
    columns = {}
    for name in (*spec.SALES_FACT_COLUMNS, spec.NET_AMOUNT):
        if name in NARROWED:
            columns[name] = "int"
        elif name in spec.SALES_LONGS:
            columns[name] = "bigint"
        elif name in spec.SALES_DOUBLES or name == spec.NET_AMOUNT:
            columns[name] = "double"
        elif name in spec.SALES_DATES:
            columns[name] = "date"
        else:
            columns[name] = "boolean" if name == "is_subscription" else "string"
    return _ddl(columns)


def sheet_ddl(names: tuple[str, ...]) -> str:
    """Sheet columns as served: timestamps are days by then."""
    return _ddl({
        name: "date" if name in spec.SHEET_TIMESTAMPS else spec.sheet_type(name).simpleString()
        for name in names
    })


PROJECTION_DDL = "`Data` string, `Valor` decimal(18,2)"


def serving_ddl() -> dict[str, str]:
    """View name -> column list, for every gold table with a known schema."""
    views = {}
    for level in spec.ADS_LEVELS.values():
        views[f"ads_f_{level.name}"] = ads_fact_ddl(level)
        views[f"ads_{level.dimension.name}"] = _ddl(dict.fromkeys(level.dimension.columns, "string"))
    views["sales_f_vendas"] = sales_fact_ddl()
    for dim in spec.SALES_DIMENSIONS:
        views[f"sales_{dim.name}"] = _ddl(
            {name: "bigint" if name in spec.SALES_LONGS else "string" for name in dim.columns}
        )
    views["sheet_f_vendas"] = sheet_ddl(spec.SHEET_FACT_COLUMNS)
    for dim in spec.SHEET_DIMENSIONS:
        views[f"sheet_{dim.name}"] = sheet_ddl(dim.columns)
    views["sheet_projetadas"] = PROJECTION_DDL
    return views


def serve(spark: SparkSession, name: str, df: DataFrame, ddl: str | None = None) -> DataFrame:
    """(Re)create the view ``name`` over ``df`` with its declared columns and types."""
    typed_as(df, ddl or serving_ddl()[name]).createOrReplaceTempView(name)
    return spark.table(name)


def serve_table(spark: SparkSession, name: str, df: DataFrame, location: str, ddl: str | None = None) -> DataFrame:
    """Drop and make again the catalogue table ``name``: a copy at ``location`` with its declared columns, types and column statistics.

    Its files are the table's own, so that readers of the catalogue see one load whole; a new load takes a new location.
    """
    declared = ddl or serving_ddl()[name]
    typed_as(df, declared).write.mode("overwrite").parquet(location)
    spark.sql(f"drop table if exists {name}")
    spark.sql(f"create table {name} ({declared}) using parquet location '{location}'")
    spark.sql(f"analyze table {name} compute statistics for all columns")
    return spark.table(name)
