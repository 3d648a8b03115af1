"""Whole mart jobs, from landing records to gold, over two loads where the mart is incremental."""

from __future__ import annotations

import datetime as dt
import re
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F, types as T

from lakemart import spec
from lakemart.catalog.columns import SALES_SQL
from lakemart.catalog.frames import insight_records, projection_rows, sale_records, sheet_rows, text
from lakemart.catalog.joins import CREATIVE_SQL, creative_links
from lakemart.catalog.registry import Source, query
from lakemart.functions.casts import epoch_ms_date
from lakemart.functions.nested import flatten_variant
from lakemart.plans.ads import AdsMart
from lakemart.plans.sales import SalesMart, flatten_sales
from lakemart.plans.snapshots import ProjectionsMart, SheetSalesMart, SubscriptionsMart
from lakemart.plans.serving import serve_table, serving_ddl
from lakemart.plans.together import run_together
from lakemart.session import scratch_path
from lakemart.sources.landing import ARRIVAL, raw_partition

RUN_1, RUN_2 = dt.date(2024, 2, 1), dt.date(2024, 2, 2)
LOADED_UNTIL, RESTATED_FROM = "2024-01-20", "2024-01-10"


def ads_mart(source: Source) -> AdsMart:
    return AdsMart(source.spark, scratch_path(source.spark, "ads"), "camp")


def bad_days(records: DataFrame) -> DataFrame:
    """Copies of some records under a day that is none: they end among the rejects."""
    return records.where(F.col("event_type_number") == 0).withColumn("date_start", F.lit("2024-13-05"))


def landed_records(source: Source) -> DataFrame:
    """All events as landing records, several per (day, id), with their place in the landing files."""
    place = F.struct(F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("offset"), F.col("event_id").alias("row"))
    records = insight_records(source).withColumn(ARRIVAL, place).withColumn("event_type_number", F.pmod("event_id", F.lit(97)))
    return records.unionByName(bad_days(records)).drop("event_id", "event_type_number")


def two_loads(mart: AdsMart, records: DataFrame, first: dict, second: dict) -> AdsMart:
    """A first load up to a day, then a restated window that overlaps it; either with its lookup tables."""
    restated = records.withColumn("spend", text(F.col("spend").cast("double") * 2))
    mart.load(records.where(F.col("date_start") <= LOADED_UNTIL), RUN_1, **first)
    mart.load(restated.where(F.col("date_start") >= RESTATED_FROM), RUN_2, **second)
    return mart


ADS_SQL = """
    with last as (
        select strftime(ts, '%Y-%m-%d')::date as data, cast(user_id as varchar) as campaign_id, event_id, event_type,
               value, cast(props->>'$.k' as bigint) as k from events
        qualify row_number() over (partition by cast(ts as date), user_id order by event_id desc) = 1),
    f as (
        select data, campaign_id, event_type,
               case when data >= date '2024-01-10' then value * 2 else value end as spend,
               case when event_type <> 'error' then 0.5::double end as ctr, 0.0::double as cpc, 1.0::double as frequency,
               0.0::double as cost_per_unique_click, value as purchase_value, k as impressions,
               case when event_type = 'click' then 1 else 0 end::bigint as clicks, k as reach,
               case when event_type = 'signup' then cast(trunc(value) as bigint) else 2 end as leads,
               case when event_type = 'purchase' then cast(trunc(value) as bigint) else 0 end as purchases
        from last)
"""


@query(ADS_SQL + "select * exclude (event_type) from f")
def ads_mart_fact(source: Source) -> DataFrame:
    """Repeated records and bad days on the way, over two loads."""
    mart = two_loads(ads_mart(source), landed_records(source), {}, {})
    return mart.fact.read().select(*mart.level.fact_columns)


@query("""
    select count(*) as rejects, 0 as published from events where event_id % 97 = 0
    union all
    select 0, count(distinct (cast(ts as date), user_id)) from events
""")
def ads_rejected_first_load(source: Source) -> DataFrame:
    """A first load of rejects alone creates no table; the next load, a good one, is published."""
    mart, records = ads_mart(source), insight_records(source)
    place = F.struct(F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("offset"), F.col("event_id").alias("row"))
    spoiled = records.where(F.col("event_id") % 97 == 0)
    # No two records share a day and an id, so that each of them is a reject of its own.
    spoiled = spoiled.withColumn("date_start", F.concat(F.lit("2024-13-"), text("event_id"))).drop("event_id")
    mart.load(spoiled, RUN_1)
    rejects = source.spark.read.parquet(f"{mart.rejects_root}/ingestion_date={RUN_1.isoformat()}")
    if mart.bronze.exists() or mart.fact.exists():
        raise AssertionError("rejects were published")
    mart.load(records.withColumn(ARRIVAL, place).drop("event_id"), RUN_2)
    return rejects.agg(F.count("*").alias("rejects")).withColumn("published", F.lit(0).cast("bigint")).unionByName(
        mart.fact.read().agg(F.count("*").alias("published")).withColumn("rejects", F.lit(0).cast("bigint")))


@query(ADS_SQL + """
    select campaign_id, 'campaign ' || event_type as campaign_name from f
    qualify row_number() over (partition by campaign_id order by data desc) = 1
""")
def ads_mart_dimension(source: Source) -> DataFrame:
    """The name of a campaign is the one of its last day."""
    return two_loads(ads_mart(source), landed_records(source), {}, {}).dimension.read()


LAST_EVENT_SQL = """
    select cast(user_id as varchar) as id, user_id, event_type from events
    qualify row_number() over (partition by user_id order by cast(ts as date) desc, event_id desc) = 1
"""


@query(f"""
    select id as adset_id, 'campaign ' || event_type as adset_name,
           case when user_id not in (select user_id from events where ts < timestamp '{LOADED_UNTIL}' + interval 1 day) then ''
                when user_id % 3 = 1 then 'Everyone | CA:' || id when user_id % 3 = 2 then 'CA:' || id else '' end
               as publicos_personalizados_incluidos
    from ({LAST_EVENT_SQL})
""")
def adset_mart_dimension(source: Source) -> DataFrame:
    """Only the first load looks audiences up: what it found stays, and ad sets that came later have none yet."""
    return adset_mart(source).dimension.read().fillna("", [spec.AUDIENCES])


def adset_mart(source: Source) -> AdsMart:
    """Users as ad sets; customers with the same number hold their targeting, a third has none."""
    mart = AdsMart(source.spark, scratch_path(source.spark, "adsets"), "adset")
    records = landed_records(source).select(
        "*", F.col("campaign_id").alias("adset_id"), F.col("campaign_name").alias("adset_name")
    )
    key = text("c_custkey")
    person = F.struct(key.alias("id"), F.lit(None).cast("string").alias("name"))
    everyone = F.struct(F.lit("0").alias("id"), F.lit("Everyone").alias("name"))
    form = F.col("c_custkey") % 3
    targeting = F.when(form != 0, F.struct(
        F.array(person).alias("custom_audiences"),
        F.array(F.struct(F.when(form == 1, F.array(everyone, person)).alias("custom_audiences"))).alias("flexible_spec"),
    ))
    audiences = source.customer.select(key.alias("id"), targeting.alias("targeting"))
    return two_loads(mart, records, {"audiences": audiences.unionByName(audiences)}, {})


@query(ADS_SQL + "select data, campaign_id as adset_id, * exclude (event_type, data) from f")
def adset_mart_fact(source: Source) -> DataFrame:
    mart = adset_mart(source)
    return mart.fact.read().select(*mart.level.fact_columns)


def ad_mart(source: Source) -> AdsMart:
    """Users as ads, with the links of the order of the same number."""
    mart = AdsMart(source.spark, scratch_path(source.spark, "single-ads"), "ad")
    records = landed_records(source).select(
        "*", F.col("campaign_id").alias("ad_id"), F.col("campaign_name").alias("ad_name"),
        F.col("campaign_id").alias("adset_id"),
    )
    return two_loads(mart, records, {"creatives": creative_links(source)}, {"creatives": creative_links(source)})


@query(ADS_SQL + "select data, campaign_id as ad_id, campaign_id as adset_id, * exclude (event_type, data) from f")
def ad_mart_fact(source: Source) -> DataFrame:
    mart = ad_mart(source)
    return mart.fact.read().select(*mart.level.fact_columns)


@query(f"""
    with ad as ({LAST_EVENT_SQL}), link as ({CREATIVE_SQL})
    select id as ad_id, 'campaign ' || event_type as ad_name, coalesce(video_url, '') as video_url,
           coalesce(video_url_click, '') as video_url_click, coalesce(video_thumbnail_url, '') as video_thumbnail_url
    from ad left join link on link.ad_id = ad.id
""")
def ad_mart_dimension(source: Source) -> DataFrame:
    return ad_mart(source).dimension.read()


SPLIT_DAY = "1999-06-01"


def sales_mart(source: Source) -> SalesMart:
    return SalesMart(source.spark, scratch_path(source.spark, "sales"))


SALES_MART_SQL = f"""
    with flat as ({SALES_SQL}),
    typed as (
        select * replace (case when order_date_ms >= epoch_ms(timestamp '{SPLIT_DAY}' - interval 60 day)
                               then status || '+' else status end as status),
               cast(epoch_ms(order_date_ms) as date) as data, cast(epoch_ms(approved_date_ms) as date) as approved_date,
               cast(epoch_ms(warranty_expire_date_ms) as date) as warranty_expire_date
        from flat)
"""


@query(SALES_MART_SQL + """
    select transaction, data, approved_date, warranty_expire_date, status, is_subscription, commission_as, product_id,
           buyer_ucode, producer_ucode, offer_code, payment_type, payment_method, installments_number, price_currency,
           price_value, fee_base, fee_fixed, fee_total, fee_percentage,
           coalesce(price_value, 0) - coalesce(fee_total, 0) as valor_liquido
    from typed
""")
def sales_mart_fact(source: Source) -> DataFrame:
    """A first load of the older sales, then the newer ones with changed statuses of recent ones."""
    mart, flat = sales_mart(source), flatten_sales(sale_records(source))
    day, split = epoch_ms_date(F.col("order_date_ms")), F.lit(SPLIT_DAY).cast("date")
    mart.load(flat.where(day < split), RUN_1)
    recent = flat.where(day >= F.date_sub(split, 60))
    mart.load(recent.withColumn("status", F.concat("status", F.lit("+"))), RUN_2)
    return mart.fact.read().select(*spec.SALES_FACT_COLUMNS, spec.NET_AMOUNT)


@query(SALES_MART_SQL + """
    select 'dim_cliente' as dimension, buyer_ucode as key, max(buyer_name) as name, max(buyer_email) as more
    from typed where buyer_ucode is not null group by 2
    union all
    select 'dim_produto', cast(product_id as varchar), arg_max(product_name, (data, product_name)), null from typed
    where product_id is not null group by 2
    union all
    select 'dim_oferta', offer_code, arg_max(offer_payment_mode, (data, offer_payment_mode)), null from typed
    where offer_code is not null group by 2
    union all
    select 'dim_produtor', producer_ucode, 'né', null from typed where producer_ucode is not null group by 2
""")
def sales_mart_dimensions(source: Source) -> DataFrame:
    """The four dimensions after one load of everything, each as its key and all its attributes."""
    mart = sales_mart(source)
    mart.load(flatten_sales(sale_records(source)), RUN_1)
    frames = []
    for dim in spec.SALES_DIMENSIONS:
        rows = mart.dimensions[dim.name].read()
        attributes = [name for name in dim.columns if name not in dim.key]
        if sorted(rows.columns) != sorted(dim.columns) or len(attributes) > 2:
            raise AssertionError(f"{dim.name} holds {rows.columns}")
        values = [text(name) for name in attributes] + [F.lit(None).cast("string")] * (2 - len(attributes))
        frames.append(rows.select(
            F.lit(dim.name).alias("dimension"), text(dim.key[0]).alias("key"), values[0].alias("name"), values[1].alias("more")))
    return reduce(DataFrame.unionByName, frames)


@query("""
    select o_orderkey as id, o_orderstatus as plan_name, c_name as subscriber_name,
           '[{"code":"' || o_orderpriority || '"}]' as offers, case when o_orderkey % 50 = 0 then 'rare' end as extra
    from orders left join customer on o_custkey = c_custkey
""")
def subscriptions_mart(source: Source) -> DataFrame:
    """Nested records of unknown shape, some with a field the others lack, flattened and passed through to gold."""
    root = scratch_path(source.spark, "subscriptions")
    nested = source.orders.join(source.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("name")).alias("plan"),
        F.struct(F.col("c_name").alias("name")).alias("subscriber"),
        F.array(F.struct(F.col("o_orderpriority").alias("code"))).alias("offers"),
        F.when(F.col("o_orderkey") % 50 == 0, "rare").alias("extra"),
    )
    mart = SubscriptionsMart(source.spark, root)
    nested.write.json(raw_partition(mart.raw_root, RUN_1))
    mart.load(RUN_1)
    return mart.fact.read()


@query("""
    select o_orderkey as id, case when o_orderkey % 7 = 0 then '"code ' || o_orderstatus || '"' else (o_orderkey % 100)::varchar end as mixed,
           case when o_orderkey % 2 = 0 then o_totalprice else (o_orderkey % 10)::double end as amount,
           o_orderstatus as plan_name, c_name as plan_owner_name, '[{"code":"' || o_orderpriority || '"}]' as offers,
           case when o_orderkey % 50 = 0 then 'top' end as plan_name_2
    from orders left join customer on o_custkey = c_custkey
""")
def variant_flatten(source: Source) -> DataFrame:
    """Records of open shape, parsed once: a field of several types, one that few records have, and two of one flat name."""
    joined = source.orders.join(source.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    line = F.concat(
        F.lit('{"id":'), text("o_orderkey"), F.lit(',"plan":{"name":"'), F.col("o_orderstatus"), F.lit('","owner":{"name":"'), F.col("c_name"),
        F.lit('"}},"offers":[{"code":"'), F.col("o_orderpriority"), F.lit('"}],"mixed":'),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit('"code '), F.col("o_orderstatus"), F.lit('"'))).otherwise(text(F.col("o_orderkey") % 100)),
        F.lit(',"amount":'), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("e0"))).otherwise(
            text(F.col("o_orderkey") % 10)),
        F.when(F.col("o_orderkey") % 50 == 0, ',"plan_name":"top"').otherwise(""), F.lit("}"))
    root = scratch_path(source.spark, "open-records")
    joined.select(line.alias("value")).write.text(root)
    parsed = scratch_path(source.spark, "open-variants")
    source.spark.read.text(root).select(F.parse_json("value").alias("record")).write.parquet(parsed)
    return flatten_variant(source.spark.read.parquet(parsed), "record").withColumn("amount", F.col("amount").cast("double"))


def sheet_mart(source: Source) -> SheetSalesMart:
    """An older drop with other values, then the current one; the newest is loaded."""
    mart = SheetSalesMart(source.spark, scratch_path(source.spark, "sheet"), extensions=(".csv",))
    rows = sheet_rows(source)
    for day, frame in ((RUN_1, rows.withColumn("Valor Pago", F.lit(-1.0))), (RUN_2, rows)):
        frame.write.option("header", "true").option("escape", '"').csv(f"{raw_partition(mart.raw_root, day)}/vendas.csv")
    return mart


SHEET_SQL = """
    with s as (
        select case when o_orderkey % 97 = 0 then 445793 else o_orderkey end as "ID Venda",
               cast(o_orderdate as date) as "Data da venda", cast(o_orderdate as date) + 1 as "Data de pagamento",
               o_orderkey % 500 as "ID Produto", 'offer-' || c_mktsegment as "ID Oferta", o_totalprice as "Valor Pago",
               o_orderstatus as "Status da venda", '12' || o_orderkey as "Cod. de Barras",
               nullif(c_name, 'Customer#000000007') as "Nome do comprador",
               case when o_orderpriority <> '5-LOW' or o_orderstatus <> 'P' then c_name || '@example.com' end as "Email do comprador",
               case o_orderstatus when 'O' then o_orderpriority when 'F' then '' end as "Nome Afiliado", c_mktsegment as "Nome da oferta",
               'product ' || o_orderkey % 500 as "Nome do produto", case when o_orderkey % 500 < 250 then 'course' end as "Categoria",
               '+55 11 ' || c_custkey as "Número de telefone", o_totalprice / 8 as "Taxa Voomp",
               o_orderpriority as "Método de pagamento", o_orderkey % 12 as "Recorrência atual",
               cast(o_orderdate as date) as "Data de vencimento do boleto", cast(o_orderdate as date) + 40 as "Data liberação do saldo",
               o_orderkey % 4 as "Forma de pagamento", case when o_orderkey % 3 = 0 then 'CUPOM' || o_orderkey % 9 end as "Cupom",
               o_totalprice * 2 as "Valor Oferta", o_totalprice / 4 as "Valor comissão afiliado",
               'R$ ' || o_custkey as "Valor comissão co-produtor", o_totalprice / 2 as "Valor Recebido",
               case when o_orderstatus = 'F' then 'changed their mind' end as "Motivo do reembolso",
               case when o_orderstatus = 'P' then 'no funds; card, or limit' end as "Motivo da recusa",
               case when o_orderpriority = '5-LOW' then 'Sim' else 'Não' end as "Venda inteligente",
               'kind ' || o_orderstatus as "Tipo de cobrança", o_orderkey * 7 as "ID Contrato",
               lower(o_orderstatus) as "Status de Contrato", case when o_orderpriority = '5-LOW' then 'Mensal' else 'Anual' end as "Período",
               12::bigint as "Recorrência total", cast(o_custkey % 30 as varchar) as "Assinaturas em atraso (dias)",
               o_orderkey + 100000 as "Nota fiscal", case when o_orderkey % 5 = 0 then 'Sim' end as "Order Bump",
               'UF' || c_nationkey as "UF Origem", 1.25::double as "Taxa de câmbio",
               'https://pay.example/b?id=' || o_orderkey as "Link Boleto", 'Rua "Azul", ' || c_custkey as "Endereço físico",
               '000.' || c_custkey || '-00' as "CPF/CNPJ", case when o_orderkey % 500 < 100 then 'digital' end as "Tipo do produto"
        from orders left join customer on o_custkey = c_custkey),
    silver as (
        select *, md5(coalesce("Nome Afiliado", '')) as "ID_Afiliado", md5("Nome do comprador" || "Email do comprador") as "ID_Cliente"
        from s where "Nome do comprador" is not null and "Email do comprador" is not null and "ID Venda" <> 445793)
"""


@query(SHEET_SQL + "select " + ", ".join(f'"{name}"' for name in spec.SHEET_FACT_COLUMNS) + " from silver")
def sheet_mart_fact(source: Source) -> DataFrame:
    mart = sheet_mart(source)
    mart.load()
    return mart.fact.read()


def _sheet_dimension_sql(dim: spec.Dimension) -> str:
    names = [name for name in dim.columns if name not in dim.key]
    values = [f'"{name}"' for name in names] + ["null"] * (5 - len(names))
    columns = ", ".join(f"{value} as a{i}" for i, value in enumerate(values))
    return f"select distinct '{dim.name}' as dimension, cast(\"{dim.key[0]}\" as varchar) as key, {columns} from silver"


@query(SHEET_SQL + " union all ".join(map(_sheet_dimension_sql, spec.SHEET_DIMENSIONS)))
def sheet_mart_dimensions(source: Source) -> DataFrame:
    """Dimensions are the distinct rows of their columns, here each as its key and all its attributes."""
    mart = sheet_mart(source)
    mart.load()
    frames = []
    for dim in spec.SHEET_DIMENSIONS:
        rows = mart.dimensions[dim.name].read()
        if sorted(rows.columns) != sorted(dim.columns):
            raise AssertionError(f"{dim.name} holds {rows.columns}")
        names = [name for name in dim.columns if name not in dim.key]
        values = [text(f"`{name}`") for name in names] + [F.lit(None).cast("string")] * (5 - len(names))
        frames.append(rows.select(F.lit(dim.name).alias("dimension"), text(f"`{dim.key[0]}`").alias("key"), *[
            value.alias(f"a{i}") for i, value in enumerate(values)]))
    return reduce(DataFrame.unionByName, frames)


@query("""
    select '01/' || strftime(o_orderdate, '%m/%Y') as "Data",
           cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as "Valor"
    from orders group by 1
""")
def projections_mart(source: Source) -> DataFrame:
    """Month labels and currency text of the newest drop, as dates and amounts."""
    mart = ProjectionsMart(source.spark, scratch_path(source.spark, "projections"))
    sheet = projection_rows(source).write.option("header", "true")
    sheet.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(
        f"{raw_partition(mart.raw_root, RUN_1)}/projetadas.csv"
    )
    mart.load()
    return mart.fact.read()


def _served_column(name: str, kind: str) -> str:
    """A column of that type from the nation's number, the same in both dialects but for the names of types."""
    key = "cast(n_nationkey as bigint)"
    if kind == "date":
        return f"date '2024-01-01' + cast({key} as int) as \"{name}\""
    return f"{'n_nationkey % 2 = 0' if kind == 'boolean' else key}::{ {'string': 'varchar'}.get(kind, kind) } as \"{name}\""


def _served_sql() -> str:
    parts = []
    for table, ddl in serving_ddl().items():
        # Name, types and sums over the first and the last column, as a reader of the catalogue sees them.
        columns = re.findall(r"`([^`]+)` (\w+(?:\(\d+,\d+\))?)", ddl)
        types = ",".join(kind for _, kind in columns)
        inner = ", ".join(_served_column(name, kind) for name, kind in columns)
        first, last = columns[0][0], columns[-1][0]
        parts.append(f"""select '{table}' as table_name, {len(columns)}::bigint as n_columns, '{types}' as types, count(*) as row_count,
            max("{first}"::varchar) as first_max, max("{last}"::varchar) as last_max from (select {inner} from nation)""")
    return " union all ".join(parts)


@query(_served_sql())
def serving_tables(source: Source) -> DataFrame:
    """Every declared gold table as a catalogue table of its own, with its declared types; the facts are made twice."""
    key, root = F.col("n_nationkey").cast("bigint"), scratch_path(source.spark, "served")
    tables = serving_ddl()

    def made(name: str) -> None:
        fields = T.StructType.fromDDL(tables[name]).fields
        columns = [
            (F.date_add(F.lit("2024-01-01").cast("date"), key.cast("int")) if isinstance(field.dataType, T.DateType)
             else key % 2 == 0 if isinstance(field.dataType, T.BooleanType) else key).cast(field.dataType).alias(field.name) for field in fields]
        for version in (0, 1) if "_f_" in name else (1,):
            serve_table(source.spark, name, source.nation.where(F.lit(version == 1)).select(columns), f"{root}/{name}/v={version}")

    run_together([partial(made, name) for name in tables])
    found = []
    for name in tables:
        served = source.spark.table(name)
        types = ",".join(field.dataType.simpleString() for field in served.schema.fields)
        found.append(served.agg(F.count("*").alias("row_count"), *[
            F.max(F.col(f"`{column}`").cast("string")).alias(alias) for column, alias in ((served.columns[0], "first_max"), (served.columns[-1], "last_max"))
        ]).select(F.lit(name).alias("table_name"), F.lit(len(served.columns)).cast("bigint").alias("n_columns"), F.lit(types).alias("types"),
                  "row_count", "first_max", "last_max"))
    return reduce(DataFrame.unionByName, found)
