"""Lookups and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.catalog.frames import text
from lakemart.catalog.registry import Source, query
from lakemart.operators.quality import coverage
from lakemart.sources.colocated import colocated, colocated_join
from lakemart.operators.lookups import lookup, resolve_creatives, star_join as join_dimensions


@query("""
    select o_orderkey, o_custkey, coalesce(c_mktsegment, '') as c_mktsegment from orders
    left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey
""")
def lookup_default(source: Source) -> DataFrame:
    labels = source.customer.where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return lookup(source.orders.select("o_orderkey", "o_custkey"), labels, ["o_custkey"], {"c_mktsegment": ""})


@query("""
    select l_orderkey, l_linenumber, l_quantity, p_brand, s_name, o_orderstatus
    from lineitem left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey
    left join orders on l_orderkey = o_orderkey
""")
def star_join(source: Source) -> DataFrame:
    """Line items with their order, part and supplier."""
    fact = source.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    dims = [
        (source.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), ["l_partkey"]),
        (source.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), ["l_suppkey"]),
        (source.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), ["l_orderkey"]),
    ]
    return join_dimensions(fact, dims).select(
        "l_orderkey", "l_linenumber", "l_quantity", "p_brand", "s_name", "o_orderstatus"
    )


@query("""
    select l_orderkey, l_linenumber, l_quantity, o_orderstatus, o_totalprice
    from (select * replace (case when l_linenumber = 7 then null else l_orderkey end as l_orderkey) from lineitem)
    left join (select * from orders where o_orderkey % 10 <> 0) on l_orderkey = o_orderkey
""")
def bucketed_star_join(source: Source) -> DataFrame:
    """Line items and orders in buckets of the order: joined without moving either; some lines lack the order's key."""
    lines = source.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")))
    orders = source.orders.where("o_orderkey % 10 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice")
    return colocated_join(colocated(lines, "l_orderkey", 8), colocated(orders, "l_orderkey", 8), "l_orderkey")


# Ads are orders, videos are parts and posts are customers. An order shows its story video, a feed
# video, a post or nothing, by its status and priority.
CREATIVE_SQL = """
    with ad as (
        select cast(o_orderkey as varchar) as ad_id,
               case when o_orderstatus = 'F' then cast(o_orderkey % 4000 as varchar)
                    when o_orderstatus = 'O' and o_orderpriority <> '5-LOW' then 'f' || (o_orderkey % 3000) end as vid,
               case when o_orderstatus = 'O' then o_custkey || '_1'
                    when o_orderpriority in ('1-URGENT', '2-HIGH') then '77_' || o_custkey end as pid
        from orders),
    video as (
        select cast(p_partkey as varchar) as id, case p_size % 4 when 0 then '' when 1 then '/x/videos/' || p_partkey || '/'
                   when 2 then 'https://example.com/' || p_partkey else null end as link,
               case when p_size % 3 = 0 then p_name when p_size % 3 = 1 then 'thumb ' || p_brand else '' end as thumb from part
        union all select 'f' || p_partkey, '/' || p_type, p_name from part),
    post as (
        select c_custkey || '_1' as id, case when c_acctbal > 0 then 'https://example.com/videos/' || c_custkey end as link,
               nullif(c_mktsegment, 'BUILDING') as thumb from customer),
    met as (
        select ad_id, vid, pid, v.link as vlink, v.thumb as vthumb, p.link as plink, p.thumb as pthumb
        from ad left join video v on v.id = vid left join post p on p.id = pid),
    linked as (
        select *, case when vid is not null then case
                when coalesce(vlink, '') = '' then 'https://www.facebook.com/watch/?v=' || vid
                when vlink like 'https://%' then vlink
                when vlink like '/x/videos/%' then 'https://www.facebook.com/watch/?v=' || regexp_extract(vlink, '/videos/([0-9]+)', 1)
                else 'https://www.facebook.com' || vlink end
            when pid is not null then coalesce(plink, 'https://www.facebook.com/' || split_part(pid, '_', 1) || '/posts/' || split_part(pid, '_', 2))
            else '' end as video_url from met)
    select ad_id, video_url,
           case when regexp_matches(video_url, '/videos/[0-9]+')
                then 'https://www.facebook.com/watch/?v=' || regexp_extract(video_url, '/videos/([0-9]+)', 1)
                else video_url end as video_url_click,
           coalesce(case when vid is not null then vthumb else pthumb end, '') as video_thumbnail_url
    from linked
"""


def creative_links(source: Source) -> DataFrame:
    status, priority, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey")
    story_video = F.when(status == "F", text(key % 4000))
    feed_video = F.when((status == "O") & (priority != "5-LOW"), F.concat(F.lit("f"), text(key % 3000)))
    creative = F.struct(
        F.struct(F.struct(story_video.alias("video_id")).alias("video_data")).alias("object_story_spec"),
        F.struct(F.array(
            F.struct(F.lit("").alias("video_id")), F.struct(feed_video.alias("video_id"))
        ).alias("videos")).alias("asset_feed_spec"),
        F.when(status == "O", F.concat(text("o_custkey"), F.lit("_1"))).alias("effective_object_story_id"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("77_"), text("o_custkey"))).alias("object_story_id"),
    )
    creatives = source.orders.select(text(key).alias("ad_id"), creative.alias("creative"))

    part, size = text("p_partkey"), F.col("p_size")
    thumbnail = F.struct(F.array(F.struct(F.concat(F.lit("thumb "), "p_brand").alias("uri"))).alias("data"))
    story_videos = source.part.select(
        part.alias("id"),
        F.when(size % 4 == 0, "").when(size % 4 == 1, F.concat(F.lit("/x/videos/"), part, F.lit("/")))
        .when(size % 4 == 2, F.concat(F.lit("https://example.com/"), part)).alias("permalink_url"),
        F.when(size % 3 == 0, F.col("p_name")).when(size % 3 == 1, "").alias("picture"),
        F.when(size % 3 == 1, thumbnail).alias("thumbnails"),
    )
    feed_videos = source.part.select(
        F.concat(F.lit("f"), part).alias("id"), F.concat(F.lit("/"), "p_type").alias("permalink_url"),
        F.col("p_name").alias("picture"), thumbnail.alias("thumbnails"),
    )
    posts = source.customer.select(
        F.concat(text("c_custkey"), F.lit("_1")).alias("id"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("https://example.com/videos/"), text("c_custkey"))).alias("permalink_url"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("full_picture"),
    )
    # Every lookup table holds some ids twice.
    again = creatives.unionByName(creatives.where(F.col("ad_id").endswith("7")))
    return resolve_creatives(again, story_videos.unionByName(feed_videos).unionByName(feed_videos), posts.unionByName(posts))


@query(CREATIVE_SQL)
def creative_resolve(source: Source) -> DataFrame:
    return creative_links(source)


@query(f"select count(distinct ad_id) filter (video_url <> '') as resolved, count(distinct ad_id) as total from ({CREATIVE_SQL})")
def resolve_coverage(source: Source) -> DataFrame:
    """How many distinct ads got a link, counted over their daily rows."""
    links = creative_links(source)
    return coverage(links.unionByName(links), "ad_id", "video_url")
