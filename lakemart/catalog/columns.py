"""Casts, cleaning, keys and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lakemart.catalog.frames import (
    order_day, brl, milliseconds, projection_rows, sale_records, text,
)
from lakemart.catalog.registry import Source, query
from lakemart.functions.casts import (
    date_epoch_ms, iso_date as parse_iso_date, lenient_cast as cast_leniently,
)
from lakemart.functions.links import click_url, video_url
from lakemart.functions.nested import action_count, action_value, audience_label as label_audiences, flatten_structs
from lakemart.functions.text import (
    MONTH_NUMBERS, currency_decimal as parse_currency, md5_key, month_label_date, text_day,
)
from lakemart.operators.projection import (
    dates_only, epoch_columns_to_dates, fill_defaults, net_amount as add_net_amount, writable,
)
from lakemart.plans.sales import flatten_sales
from lakemart.plans.serving import serve
from lakemart.plans.snapshots import projection_fact


@query("""
    with t as (select event_id, case event_type when 'error' then 'abc' when 'view' then (props->>'$.k') || '.5'
                   when 'click' then ' ' || (props->>'$.k') when 'signup' then (props->>'$.k') || 'd'
                   else props->>'$.k' end as raw from events)
    select event_id, case when regexp_full_match(raw, '[0-9]+') then cast(raw as bigint) end as as_long,
           case when regexp_full_match(raw, '[0-9]+([.][0-9]+)?') then cast(raw as double) end as as_double,
           raw as as_text
    from t
""")
def lenient_cast(source: Source) -> DataFrame:
    kind, number = F.col("event_type"), F.get_json_object("props", "$.k")
    raw = (
        F.when(kind == "error", "abc").when(kind == "view", F.concat(number, F.lit(".5")))
        .when(kind == "click", F.concat(F.lit(" "), number)).when(kind == "signup", F.concat(number, F.lit("d")))
        .otherwise(number)
    )
    rows = source.events.select("event_id", raw.alias("as_long"), raw.alias("as_double"), raw.alias("as_text"))
    return cast_leniently(rows, {
        "as_long": T.LongType(), "as_double": T.DoubleType(), "as_text": T.StringType(), "absent": T.LongType(),
    })


@query("""
    select o_orderkey, case when o_orderpriority in ('1-URGENT', '5-LOW') then cast(o_orderdate as date) end as day
    from orders
""")
def iso_date(source: Source) -> DataFrame:
    priority = F.col("o_orderpriority")
    written = (
        F.when(priority == "2-HIGH", F.date_format(order_day(), "dd/MM/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(order_day(), "yyyy"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(order_day(), "yyyy-13-dd"))
        .otherwise(text(order_day()))
    )
    return source.orders.select("o_orderkey", parse_iso_date(written).alias("day"))


@query("""
    select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate + to_hours(23) as date) as shipped,
           cast(l_shipdate + to_hours(24) as date) as paid from lineitem
""")
def date_only_fact(source: Source) -> DataFrame:
    rows = source.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_shipdate") + F.expr("interval 23 hours")).alias("shipped"),
        (F.col("l_shipdate") + F.expr("interval 24 hours")).alias("paid"),
    )
    return dates_only(rows, ["shipped", "paid", "absent"])


@query("""
    select o_orderkey, cast(o_orderdate as date) as data, cast(o_orderdate as date) - 14610 as approved_date,
           epoch_ms(date_trunc('day', o_orderdate)) as midnight from orders
""")
def epoch_ms_date(source: Source) -> DataFrame:
    """Milliseconds anywhere in a day, before and after 1970, back to the UTC day."""
    within_day = F.pmod(F.col("o_orderkey") * 7919, F.lit(86_400_000))
    rows = source.orders.select(
        "o_orderkey",
        milliseconds(order_day(), within_day).alias("order_date_ms"),
        milliseconds(F.date_sub(order_day(), 14610), within_day).alias("approved_date_ms"),
    )
    dated = epoch_columns_to_dates(
        rows, {"data": "order_date_ms", "approved_date": "approved_date_ms", "warranty": "absent_ms"}
    )
    return dated.withColumn("midnight", date_epoch_ms(F.col("data")))


@query("""
    select l_orderkey, l_linenumber, l_partkey,
           coalesce(case when l_returnflag <> 'R' then l_extendedprice end, 0)
           - coalesce(case when l_linestatus <> 'O' then l_tax end, 0) as net
    from lineitem
""")
def net_amount(source: Source) -> DataFrame:
    rows = source.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price_value"),
        F.when(F.col("l_linestatus") != "O", F.col("l_tax")).alias("fee_total"),
    )
    return add_net_amount(rows, "price_value", "fee_total", "net").drop("price_value", "fee_total")


@query("""
    select event_id, case when event_type = 'error' then 0.0 else value end as spend,
           case when event_type = 'view' then '0' else cast(user_id as varchar) end as reach, '' as video_url
    from events
""")
def default_fill(source: Source) -> DataFrame:
    rows = source.events.select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("spend"),
        F.when(F.col("event_type") != "view", text("user_id")).alias("reach"),
    )
    return fill_defaults(rows, {"spend": 0.0, "reach": 0, "video_url": ""})


@query("""
    select event_id, epoch_us(ts) as instant, cast(null as varchar) as untyped from events
""")
def utc_sanitize(source: Source) -> DataFrame:
    """Zone-less event times keep their wall clock as UTC instants; an untyped column becomes text."""
    clean = writable(source.events.select("event_id", "ts", F.lit(None).alias("untyped")))
    return clean.select("event_id", F.unix_micros("ts").alias("instant"), "untyped")


SALES_SQL = """
    select 'HP' || o_orderkey as transaction, o_orderstatus as status,
           epoch_ms(date_trunc('day', o_orderdate)) + (o_orderkey * 7919) % 86400000 as order_date_ms,
           case when o_orderstatus <> 'P' then epoch_ms(date_trunc('day', o_orderdate)) + 86400000 + (o_orderkey * 7919) % 86400000 end as approved_date_ms,
           epoch_ms(date_trunc('day', o_orderdate)) + 30 * 86400000::bigint + (o_orderkey * 7919) % 86400000 as warranty_expire_date_ms,
           o_orderpriority = '1-URGENT' as is_subscription, 'PRODUCER' as commission_as,
           case when o_orderstatus <> 'P' then o_orderkey % 500 end as product_id,
           case when o_orderstatus <> 'P' then 'product ' || o_orderstatus end as product_name,
           cast(c_custkey as varchar) as buyer_ucode, c_name as buyer_name, c_name || '@example.com' as buyer_email,
           'nation ' || c_nationkey as producer_ucode, 'né' as producer_name,
           'offer-' || c_mktsegment as offer_code, o_orderpriority as offer_payment_mode,
           'CARD' as payment_type, o_orderpriority as payment_method, o_orderkey % 12 as installments_number,
           'BRL' as price_currency, case when o_orderpriority <> '5-LOW' then o_totalprice end as price_value,
           case when o_orderstatus <> 'P' then o_totalprice end as fee_base,
           case when o_orderstatus <> 'P' then 1.0::double end as fee_fixed,
           case when o_orderstatus <> 'P' then o_totalprice / 8 end as fee_total,
           case when o_orderstatus <> 'P' then 9::bigint end as fee_percentage,
           case when o_orderstatus <> 'P' then 'BRL' end as fee_currency
    from orders left join customer on o_custkey = c_custkey
"""


@query(SALES_SQL)
def flatten_record(source: Source) -> DataFrame:
    return flatten_sales(sale_records(source))


@query("""
    select o_orderkey as id, o_orderstatus as plan_name, cast(null as varchar) as plan_code,
           o_orderpriority as a_b_c,
           '[{"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","label":"é ' || o_orderstatus || '"}]' as events,
           case when o_orderstatus <> 'P' then o_custkey end as buyer_key
    from orders
""")
def flatten_generic(source: Source) -> DataFrame:
    """Nested structs, an array, an empty struct's absence and two paths with one flat name."""
    nested = source.orders.select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("name"), F.lit(None).cast("string").alias("code")).alias("plan"),
        F.struct(F.lit("hidden").alias("b_c")).alias("a"),
        F.struct(F.col("o_orderpriority").alias("c")).alias("a_b"),
        F.array(F.struct(
            text(order_day()).alias("day"), F.concat(F.lit("é "), "o_orderstatus").alias("label")
        )).alias("events"),
        F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_custkey").alias("key"))).alias("buyer"),
    )
    return flatten_structs(nested)


@query("""
    select event_id,
           case when event_type = 'signup' then cast(trunc(value) as bigint) when event_type = 'view' then 2 else 0 end as leads,
           case when event_type = 'purchase' then value when event_type = 'error' then 0.0 else 2.9 end as purchase_value,
           cast(0 as bigint) as nothing
    from events
""")
def action_measures(source: Source) -> DataFrame:
    """First action of a type wins, even when its value is unreadable; a missing type gives 0."""
    kind = F.col("event_type")

    def action(action_type, value):
        return F.struct(action_type.alias("action_type"), value.cast("string").alias("value"))

    actions = F.when(kind == "error", F.array(
        action(F.lit("purchase"), F.lit("x")), action(F.lit("purchase"), F.lit("9")),
    )).when(kind == "view", F.array(
        action(F.lit("signup"), F.lit("2.9")), action(F.lit("purchase"), F.lit("2.9")),
    )).otherwise(F.array(action(kind, F.col("value")), action(F.lit("purchase"), F.lit("2.9"))))
    rows = source.events.select("event_id", actions.alias("actions"))
    return rows.select(
        "event_id",
        action_count(F.col("actions"), "signup").alias("leads"),
        action_value(F.col("actions"), "purchase").alias("purchase_value"),
        action_count(F.col("actions"), "no_such_action").alias("nothing"),
    )


@query("""
    select c_custkey, md5(c_name || coalesce(nullif(c_mktsegment, 'BUILDING'), '')) as customer_key,
           md5(coalesce(nullif(c_mktsegment, 'BUILDING'), '')) as affiliate_key
    from customer
""")
def md5_keys(source: Source) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return source.customer.select(
        "c_custkey", md5_key(F.col("c_name"), segment).alias("customer_key"), md5_key(segment).alias("affiliate_key")
    )


@query("select o_orderkey, cast(o_totalprice as decimal(18,2)) as amount from orders")
def currency_decimal(source: Source) -> DataFrame:
    written = brl(F.col("o_totalprice").cast("decimal(18,2)"))
    return source.orders.select("o_orderkey", parse_currency(written).alias("amount"))


@query("""
    select o_orderkey, case when o_orderstatus <> 'P' then '01/' || strftime(o_orderdate, '%m/%Y') end as first_day
    from orders
""")
def month_label(source: Source) -> DataFrame:
    """Portuguese month labels, blanks around them and mixed case; unknown months are null."""
    names = F.array(*map(F.lit, MONTH_NUMBERS))
    name = F.when(F.col("o_orderstatus") == "P", "xyz").otherwise(F.element_at(names, F.month(order_day())))
    label = F.concat(
        F.lit(" "), F.when(F.col("o_orderstatus") == "F", F.upper(name)).otherwise(name), F.lit("/"),
        text(F.year(order_day())), F.lit(" "),
    )
    return source.orders.select("o_orderkey", month_label_date(label).alias("first_day"))


@query("""
    select '01/' || strftime(o_orderdate, '%m/%Y') as "Data",
           cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as "Valor"
    from orders group by 1
""")
def projection_order(source: Source) -> DataFrame:
    """Projections in chronological order of their text date."""
    return projection_fact(projection_rows(source)).orderBy(text_day(F.col("Data")))


@query(r"""
    with u as (
        select o_orderkey as id, case o_orderkey % 8
            when 0 then '' when 1 then 'https://example.com/videos/' || o_orderkey when 2 then '/page/videos/' || o_orderkey || '/'
            when 3 then cast(o_orderkey as varchar) when 4 then o_custkey || '_' || o_orderkey
            when 5 then '/p/' || o_orderkey when 6 then o_orderkey || chr(10) else null end as url from orders
        union all select -1 - page_id, url from pages)
    select id, coalesce(case
               when url like 'http://%' or url like 'https://%' then url
               when regexp_matches(url, '/videos/[0-9]+') then 'https://www.facebook.com/watch/?v=' || regexp_extract(url, '/videos/([0-9]+)', 1)
               when regexp_full_match(url, '[0-9]+') then 'https://www.facebook.com/watch/?v=' || url
               when regexp_full_match(url, '[0-9]+_[0-9]+') then 'https://www.facebook.com/' || split_part(url, '_', 1) || '/posts/' || split_part(url, '_', 2)
               when url like '/%' then 'https://www.facebook.com' || url else url end, '') as video_url,
           coalesce(case
               when regexp_matches(url, '/videos/[0-9]+') then 'https://www.facebook.com/watch/?v=' || regexp_extract(url, '/videos/([0-9]+)', 1)
               when url like 'http://%' or url like 'https://%' then url
               when regexp_full_match(url, '[0-9]+') then 'https://www.facebook.com/watch/?v=' || url
               when regexp_full_match(url, '[0-9]+_[0-9]+') then 'https://www.facebook.com/' || split_part(url, '_', 1) || '/posts/' || split_part(url, '_', 2)
               when url like '/%' then 'https://www.facebook.com' || url else url end, '') as click_url
    from u
""")
def url_normalize(source: Source) -> DataFrame:
    key = text("o_orderkey")
    form = F.col("o_orderkey") % 8
    url = (
        F.when(form == 0, "").when(form == 1, F.concat(F.lit("https://example.com/videos/"), key))
        .when(form == 2, F.concat(F.lit("/page/videos/"), key, F.lit("/"))).when(form == 3, key)
        .when(form == 4, F.concat(text("o_custkey"), F.lit("_"), key)).when(form == 5, F.concat(F.lit("/p/"), key))
        .when(form == 6, F.concat(key, F.lit("\n")))
    )
    links = source.orders.select(F.col("o_orderkey").alias("id"), url.alias("url")).unionByName(
        source.pages.select((-1 - F.col("page_id")).alias("id"), "url")
    )
    return links.select("id", video_url(F.col("url")).alias("video_url"), click_url(F.col("url")).alias("click_url"))


@query("""
    with t as (
        select o_orderkey, case when o_orderstatus = 'P' then null else
            [struct_pack(id := o_custkey::varchar, name := o_orderpriority), struct_pack(id := '9' || o_custkey, name := null),
             struct_pack(id := '9' || o_custkey, name := ''), struct_pack(id := null, name := 'é' || o_orderstatus),
             struct_pack(id := '10', name := o_orderpriority)]
            || case when o_orderstatus = 'F' then [struct_pack(id := '5', name := 'Alpha')] else [] end end as who
        from orders)
    select o_orderkey, coalesce(array_to_string(
        list_sort(list_distinct([w.name for w in who if coalesce(w.name, '') <> '']))
        || ['CA:' || i for i in list_sort(list_distinct([w.id for w in who if coalesce(w.name, '') = '' and w.id is not null]))],
        ' | '), '') as label
    from t
""")
def audience_label(source: Source) -> DataFrame:
    """Audiences named in either place, each once, then the unnamed ones by id."""
    def person(ident, name):
        return F.struct(ident.cast("string").alias("id"), name.cast("string").alias("name"))

    listed = F.array(
        person(F.col("o_custkey"), F.col("o_orderpriority")),
        person(F.concat(F.lit("9"), text("o_custkey")), F.lit(None)),
        person(F.lit(None), F.concat(F.lit("é"), F.col("o_orderstatus"))),
    )
    again = F.array(
        person(F.concat(F.lit("9"), text("o_custkey")), F.lit("")), person(F.lit("10"), F.col("o_orderpriority"))
    )
    more = F.when(F.col("o_orderstatus") == "F", F.array(person(F.lit("5"), F.lit("Alpha"))))
    targeting = F.when(F.col("o_orderstatus") != "P", F.struct(
        listed.alias("custom_audiences"),
        F.array(F.struct(again.alias("custom_audiences")), F.struct(more.alias("custom_audiences"))).alias("flexible_spec"),
    ))
    return source.orders.select("o_orderkey", label_audiences(targeting).alias("label"))


@query("""
    select cast(event_id as integer) as event_id, cast(user_id as varchar) as campaign_id, value as spend, cast(ts as date) as data
    from events
""")
def serving_view(source: Source) -> DataFrame:
    """A view recreated with declared names, order and types."""
    rows = source.events.select(F.col("user_id").alias("campaign_id"), F.col("value").alias("spend"), "event_id", F.col("ts").alias("data"))
    return serve(source.spark, "served_events", rows, "event_id int, campaign_id string, spend double, data date")
