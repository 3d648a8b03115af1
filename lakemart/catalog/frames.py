"""The driver tables seen as mart inputs: daily metrics, sale records, sheets, creatives."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.catalog.registry import Source
from lakemart.functions.casts import date_epoch_ms
from lakemart.functions.text import MONTH_NUMBERS

TARGET_UNTIL = dt.date(2024, 1, 20)
SOURCE_FROM = dt.date(2024, 1, 11)


def daily_events(source: Source) -> DataFrame:
    return source.events.withColumn("data", F.col("ts").cast("date"))


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def milliseconds(day: Column, within_day: Column) -> Column:
    return date_epoch_ms(day) + within_day


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def insight_records(source: Source) -> DataFrame:
    """Events as ads landing records: one per event, several per (day, user)."""
    value = text("value")
    return source.events.select(
        "event_id",
        text("user_id").alias("campaign_id"),
        F.concat(F.lit("campaign "), text("event_type")).alias("campaign_name"),
        text(F.col("ts").cast("date")).alias("date_start"),
        text(F.col("ts").cast("date")).alias("date_stop"),
        value.alias("spend"),
        F.get_json_object("props", "$.k").alias("impressions"),
        F.when(F.col("event_type") == "click", F.lit("1")).alias("clicks"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.lit("0.5")).alias("ctr"),
        F.lit(None).cast("string").alias("cpc"),
        F.get_json_object("props", "$.k").alias("reach"),
        F.lit("1e0").alias("frequency"),
        F.lit(None).cast("string").alias("cost_per_unique_click"),
        F.array(
            F.struct(
                F.when(F.col("event_type") == "signup", F.lit("lead")).otherwise(F.col("event_type"))
                .alias("action_type"),
                value.alias("value"),
            ),
            F.struct(F.lit("omni_purchase").alias("action_type"), value.alias("value")),
            F.struct(F.lit("lead").alias("action_type"), F.lit("2.9").alias("value")),
        ).alias("actions"),
    )


def sale_records(source: Source) -> DataFrame:
    """Orders with their customer as nested sale records, some without product or buyer."""
    sale_day = order_day()
    rows = source.orders.join(
        source.customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    within_day = F.pmod(F.col("o_orderkey") * 7919, F.lit(86_400_000))
    pending = F.col("o_orderstatus") == "P"
    purchase = F.struct(
        F.concat(F.lit("HP"), text("o_orderkey")).alias("transaction"),
        F.col("o_orderstatus").alias("status"),
        milliseconds(sale_day, within_day).alias("order_date"),
        F.when(~pending, milliseconds(F.date_add(sale_day, 1), within_day)).alias("approved_date"),
        milliseconds(F.date_add(sale_day, 30), within_day).alias("warranty_expire_date"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_subscription"),
        F.lit("PRODUCER").alias("commission_as"),
        F.struct(
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("value"),
            F.lit("BRL").alias("currency_code"),
        ).alias("price"),
        F.struct(
            F.lit("CARD").alias("type"), F.col("o_orderpriority").alias("method"),
            F.pmod("o_orderkey", F.lit(12)).alias("installments_number"),
        ).alias("payment"),
        F.when(~pending, F.struct(
            F.col("o_totalprice").alias("base"), F.lit(1.0).alias("fixed"),
            (F.col("o_totalprice") / 8).alias("total"), F.lit(9).cast("bigint").alias("percentage"),
            F.lit("BRL").alias("currency_code"),
        )).alias("hotmart_fee"),
        F.struct(
            F.concat(F.lit("offer-"), text("c_mktsegment")).alias("code"),
            F.col("o_orderpriority").alias("payment_mode"),
        ).alias("offer"),
    )
    return rows.select(
        purchase.alias("purchase"),
        F.when(~pending, F.struct(
            F.pmod("o_orderkey", F.lit(500)).alias("id"), F.concat(F.lit("product "), text("o_orderstatus")).alias("name")
        )).alias("product"),
        F.when(F.col("c_custkey").isNotNull(), F.struct(
            text("c_custkey").alias("ucode"), F.col("c_name").alias("name"),
            F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        )).alias("buyer"),
        F.struct(
            F.concat(F.lit("nation "), text("c_nationkey")).alias("ucode"), F.lit("né").alias("name")
        ).alias("producer"),
    )


def sheet_rows(source: Source) -> DataFrame:
    """Orders with their customer under all columns of the sheet; some contacts are missing."""
    rows = source.orders.join(source.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    low = F.col("o_orderpriority") == "5-LOW"
    return rows.select(
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(445793).cast("bigint")).otherwise(F.col("o_orderkey")).alias("ID Venda"),
        F.col("o_orderdate").alias("Data da venda"),
        (F.col("o_orderdate") + F.expr("interval 30 hours")).alias("Data de pagamento"),
        F.pmod("o_orderkey", F.lit(500)).alias("ID Produto"),
        F.concat(F.lit("offer-"), text("c_mktsegment")).alias("ID Oferta"),
        F.col("o_totalprice").alias("Valor Pago"),
        F.col("o_orderstatus").alias("Status da venda"),
        F.concat(F.lit("12"), text("o_orderkey")).alias("Cod. de Barras"),
        F.nullif(F.col("c_name"), F.lit("Customer#000000007")).alias("Nome do comprador"),
        F.when(~low | (F.col("o_orderstatus") != "P"), F.concat(F.col("c_name"), F.lit("@example.com")))
        .alias("Email do comprador"),
        F.when(F.col("o_orderstatus") == "F", F.lit("")).when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .alias("Nome Afiliado"),
        F.col("c_mktsegment").alias("Nome da oferta"),
        F.concat(F.lit("product "), text(F.pmod("o_orderkey", F.lit(500)))).alias("Nome do produto"),
        F.when(F.pmod("o_orderkey", F.lit(500)) < 250, "course").alias("Categoria"),
        F.concat(F.lit("+55 11 "), text("c_custkey")).alias("Número de telefone"),
        (F.col("o_totalprice") / 8).alias("Taxa Voomp"),
        F.col("o_orderpriority").alias("Método de pagamento"),
        F.pmod("o_orderkey", F.lit(12)).alias("Recorrência atual"),
        order_day().alias("Data de vencimento do boleto"),
        (F.col("o_orderdate") + F.expr("interval 40 days")).alias("Data liberação do saldo"),
        F.pmod("o_orderkey", F.lit(4)).alias("Forma de pagamento"),
        F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.concat(F.lit("CUPOM"), text(F.pmod("o_orderkey", F.lit(9))))).alias("Cupom"),
        (F.col("o_totalprice") * 2).alias("Valor Oferta"),
        (F.col("o_totalprice") / 4).alias("Valor comissão afiliado"),
        F.concat(F.lit("R$ "), text("o_custkey")).alias("Valor comissão co-produtor"),
        (F.col("o_totalprice") / 2).alias("Valor Recebido"),
        F.when(F.col("o_orderstatus") == "F", "changed their mind").alias("Motivo do reembolso"),
        F.when(F.col("o_orderstatus") == "P", "no funds; card, or limit").alias("Motivo da recusa"),
        F.when(low, "Sim").otherwise("Não").alias("Venda inteligente"),
        F.concat(F.lit("kind "), F.col("o_orderstatus")).alias("Tipo de cobrança"),
        (F.col("o_orderkey") * 7).alias("ID Contrato"),
        F.lower("o_orderstatus").alias("Status de Contrato"),
        F.when(low, "Mensal").otherwise("Anual").alias("Período"),
        F.lit(12).alias("Recorrência total"),
        text(F.pmod("o_custkey", F.lit(30))).alias("Assinaturas em atraso (dias)"),
        (F.col("o_orderkey") + 100_000).alias("Nota fiscal"),
        F.when(F.pmod("o_orderkey", F.lit(5)) == 0, "Sim").alias("Order Bump"),
        F.concat(F.lit("UF"), text("c_nationkey")).alias("UF Origem"),
        F.lit(1.25).alias("Taxa de câmbio"),
        F.concat(F.lit("https://pay.example/b?id="), text("o_orderkey")).alias("Link Boleto"),
        F.concat(F.lit('Rua "Azul", '), text("c_custkey")).alias("Endereço físico"),
        F.concat(F.lit("000."), text("c_custkey"), F.lit("-00")).alias("CPF/CNPJ"),
        F.when(F.pmod("o_orderkey", F.lit(500)) < 100, "digital").alias("Tipo do produto"),
    )


def projection_rows(source: Source) -> DataFrame:
    """Order totals per month as the projections sheet: ``jan/2025`` and ``R$ 1.234,56``."""
    months = sorted(MONTH_NUMBERS, key=MONTH_NUMBERS.get)
    label = F.concat(
        F.lit(" "), F.upper(F.element_at(F.array(*map(F.lit, months)), F.month(order_day()))), F.lit("/"),
        text(F.year(order_day())), F.lit(" "),
    )
    return (
        source.orders.groupBy(label.alias("Mês"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("total"))
        .select("Mês", brl(F.col("total")).alias("Valor Total"))
    )


def brl(amount: Column) -> Column:
    """``R$ 1.234,56`` with a no-break space after the sign."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(amount, 2), ",.", ".,"))
