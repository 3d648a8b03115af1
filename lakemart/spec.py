"""What each mart loads: grains, columns, keys and windows. All values here are fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Dimension:
    name: str
    key: tuple[str, ...]
    columns: tuple[str, ...]


# ---- ads: restated daily metrics ---------------------------------------------------------

ADS_LOOKBACK_DAYS = 10
ADS_BACKFILL_DAYS = 90
ADS_SLICE_DAYS = 14

# Rates (ctr, cpc, frequency, cost_per_unique_click) are not additive: facts keep the daily grain.
ADS_AMOUNTS = ("spend", "ctr", "cpc", "frequency", "cost_per_unique_click", "purchase_value")
ADS_COUNTS = ("impressions", "clicks", "reach", "leads", "purchases")

# A record is kept when one of these is positive.
ADS_ACTIVITY_AMOUNTS = ("spend", "purchase_value")
ADS_ACTIVITY_COUNTS = ("impressions", "clicks", "leads", "purchases")

ADS_DEFAULTS = {
    "spend": 0.0, "impressions": 0, "clicks": 0, "ctr": 0.0, "cpc": 0.0, "reach": 0,
    "frequency": 0.0, "cost_per_unique_click": 0.0,
}

# Action types behind the derived measures. ``purchase_value`` is the count-like value of that
# action as reported, not an amount of money.
LEAD_ACTION = "lead"
PURCHASE_ACTION = "purchase"
PURCHASE_VALUE_ACTION = "omni_purchase"

AUDIENCES = "publicos_personalizados_incluidos"
VIDEO_COLUMNS = ("video_url", "video_url_click", "video_thumbnail_url")


@dataclass(frozen=True)
class AdsLevel:
    name: str
    id_column: str
    parents: tuple[str, ...]
    dimension: Dimension

    @property
    def grain(self) -> tuple[str, str]:
        return ("data", self.id_column)

    @property
    def ids(self) -> tuple[str, ...]:
        return (self.id_column, *self.parents)

    @property
    def fact_columns(self) -> tuple[str, ...]:
        return (*self.grain, *self.parents, *ADS_AMOUNTS, *ADS_COUNTS)


ADS_LEVELS = {
    "camp": AdsLevel(
        "camp", "campaign_id", (),
        Dimension("dim_camp", ("campaign_id",), ("campaign_id", "campaign_name")),
    ),
    "adset": AdsLevel(
        "adset", "adset_id", ("campaign_id",),
        Dimension("dim_adset", ("adset_id",), ("adset_id", "adset_name", AUDIENCES)),
    ),
    "ad": AdsLevel(
        "ad", "ad_id", ("adset_id", "campaign_id"),
        Dimension("dim_ad", ("ad_id",), ("ad_id", "ad_name", *VIDEO_COLUMNS)),
    ),
}

# Lookup tables of the ads, as they land.
_AUDIENCES_DDL = "array<struct<id: string, name: string>>"
ADS_LOOKUPS = {
    "audiences": f"""id string, targeting struct<
        custom_audiences: {_AUDIENCES_DDL}, flexible_spec: array<struct<custom_audiences: {_AUDIENCES_DDL}>>>""",
    "creatives": """ad_id string, creative struct<
        object_story_spec: struct<video_data: struct<video_id: string>>,
        asset_feed_spec: struct<videos: array<struct<video_id: string>>>,
        effective_object_story_id: string, object_story_id: string>""",
    "videos": "id string, permalink_url string, picture string, thumbnails struct<data: array<struct<uri: string>>>",
    "posts": "id string, permalink_url string, full_picture string",
}

ACTIONS_TYPE = T.ArrayType(T.StructType([
    T.StructField("action_type", T.StringType()), T.StructField("value", T.StringType()),
]))


# ---- sales: mutable transactions ---------------------------------------------------------

SALES_LOOKBACK_DAYS = 90
SALES_BACKFILL_DAYS = 1825
SALES_SLICE_DAYS = 90

SALES_GRAIN = ("transaction",)

# Numbers and flags land as text, quoted or not; the bronze step casts them leniently.
SALES_RECORD_DDL = """
    purchase struct<
        transaction: string, status: string, order_date: bigint, approved_date: bigint,
        warranty_expire_date: bigint, is_subscription: string, commission_as: string,
        price: struct<value: string, currency_code: string>,
        payment: struct<type: string, method: string, installments_number: string>,
        hotmart_fee: struct<base: string, fixed: string, total: string, percentage: string, currency_code: string>,
        offer: struct<code: string, payment_mode: string>>,
    product struct<id: string, name: string>,
    buyer struct<ucode: string, name: string, email: string>,
    producer struct<ucode: string, name: string>
"""

# Flat column -> path in the record.
SALES_PATHS = {
    "transaction": "purchase.transaction",
    "status": "purchase.status",
    "order_date_ms": "purchase.order_date",
    "approved_date_ms": "purchase.approved_date",
    "warranty_expire_date_ms": "purchase.warranty_expire_date",
    "is_subscription": "purchase.is_subscription",
    "commission_as": "purchase.commission_as",
    "product_id": "product.id",
    "product_name": "product.name",
    "buyer_ucode": "buyer.ucode",
    "buyer_name": "buyer.name",
    "buyer_email": "buyer.email",
    "producer_ucode": "producer.ucode",
    "producer_name": "producer.name",
    "offer_code": "purchase.offer.code",
    "offer_payment_mode": "purchase.offer.payment_mode",
    "payment_type": "purchase.payment.type",
    "payment_method": "purchase.payment.method",
    "installments_number": "purchase.payment.installments_number",
    "price_currency": "purchase.price.currency_code",
    "price_value": "purchase.price.value",
    "fee_base": "purchase.hotmart_fee.base",
    "fee_fixed": "purchase.hotmart_fee.fixed",
    "fee_total": "purchase.hotmart_fee.total",
    "fee_percentage": "purchase.hotmart_fee.percentage",
    "fee_currency": "purchase.hotmart_fee.currency_code",
}

SALES_DATES = {
    "data": "order_date_ms",
    "approved_date": "approved_date_ms",
    "warranty_expire_date": "warranty_expire_date_ms",
}
SALES_DOUBLES = ("price_value", "fee_base", "fee_fixed", "fee_total")
SALES_LONGS = ("product_id", "installments_number", "fee_percentage")
SALES_TEXTS = (
    "transaction", "status", "commission_as", "buyer_ucode", "buyer_name", "buyer_email",
    "producer_ucode", "producer_name", "offer_code", "offer_payment_mode", "payment_type",
    "payment_method", "product_name", "price_currency", "fee_currency",
)

SALES_FACT_COLUMNS = (
    "transaction", "data", "approved_date", "warranty_expire_date", "status", "is_subscription",
    "commission_as", "product_id", "buyer_ucode", "producer_ucode", "offer_code", "payment_type",
    "payment_method", "installments_number", "price_currency", "price_value", "fee_base",
    "fee_fixed", "fee_total", "fee_percentage",
)
NET_AMOUNT = "valor_liquido"

SALES_DIMENSIONS = (
    Dimension("dim_cliente", ("buyer_ucode",), ("buyer_ucode", "buyer_name", "buyer_email")),
    Dimension("dim_produto", ("product_id",), ("product_id", "product_name")),
    Dimension("dim_oferta", ("offer_code",), ("offer_code", "offer_payment_mode")),
    Dimension("dim_produtor", ("producer_ucode",), ("producer_ucode", "producer_name")),
)


# ---- spreadsheet sales and projections: whole snapshots ----------------------------------

SHEET_NAME = "Exportação de vendas"
SHEET_REQUIRED = ("Nome do comprador", "Email do comprador", "ID Venda")
SHEET_EXCLUDED_IDS = (445793, 445784)

SHEET_FACT_COLUMNS = (
    "ID Venda", "Data da venda", "Data de pagamento", "Data de vencimento do boleto",
    "Data liberação do saldo", "ID Produto", "ID Oferta", "Método de pagamento",
    "Forma de pagamento", "Cupom", "Valor Oferta", "Valor Pago", "Taxa Voomp",
    "Valor comissão afiliado", "Valor comissão co-produtor", "Valor Recebido",
    "Status da venda", "Motivo do reembolso", "Motivo da recusa", "Venda inteligente",
    "Tipo de cobrança", "ID Contrato", "Status de Contrato", "Período",
    "Recorrência atual", "Recorrência total", "Assinaturas em atraso (dias)",
    "Nota fiscal", "Order Bump", "UF Origem", "Taxa de câmbio", "Link Boleto",
    "Cod. de Barras", "ID_Afiliado", "ID_Cliente",
)
SHEET_LONGS = (
    "ID Venda", "ID Produto", "Forma de pagamento", "ID Contrato", "Recorrência atual",
    "Recorrência total", "Nota fiscal",
)
SHEET_DOUBLES = (
    "Valor Oferta", "Valor Pago", "Taxa Voomp", "Valor comissão afiliado", "Valor Recebido",
    "Taxa de câmbio",
)
SHEET_TIMESTAMPS = ("Data da venda", "Data de pagamento", "Data liberação do saldo")
SHEET_DATES = ("Data de vencimento do boleto",)

SHEET_DIMENSIONS = (
    Dimension("dim_afiliado", ("ID_Afiliado",), ("ID_Afiliado", "Nome Afiliado")),
    Dimension("dim_cliente", ("ID_Cliente",), (
        "Nome do comprador", "Email do comprador", "Número de telefone", "Endereço físico",
        "ID_Cliente", "CPF/CNPJ",
    )),
    Dimension("dim_oferta", ("ID Oferta",), ("ID Oferta", "Nome da oferta")),
    Dimension("dim_produto", ("ID Produto",), (
        "ID Produto", "Nome do produto", "Categoria", "Tipo do produto",
    )),
)
SHEET_HASHED = ("ID_Afiliado", "ID_Cliente")


def sheet_type(column: str) -> T.DataType:
    if column in SHEET_LONGS:
        return T.LongType()
    if column in SHEET_DOUBLES:
        return T.DoubleType()
    if column in SHEET_TIMESTAMPS:
        return T.TimestampType()
    return T.DateType() if column in SHEET_DATES else T.StringType()


def sheet_columns() -> list[str]:
    """Columns of the sheet itself: those of the fact and the dimensions, without the hash keys."""
    every = [*SHEET_FACT_COLUMNS, *(c for dim in SHEET_DIMENSIONS for c in dim.columns)]
    return [name for name in dict.fromkeys(every) if name not in SHEET_HASHED]


# ---- maintenance -------------------------------------------------------------------------

RETENTION_HOURS = 168


# ---- arrivals ----------------------------------------------------------------------------

ARRIVAL_POLL_SECONDS = 120
ARRIVAL_GIVE_UP_SECONDS = 1800
