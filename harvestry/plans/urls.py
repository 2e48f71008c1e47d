"""URL and date functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import dates, urls
from harvestry.functions import text as tx
from harvestry.plans.inputs import NOTICE
from harvestry.plans.registry import query

BASE = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)"
PATH = r"regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)"


@query("l1_absolute_url", f"""
with p as (select page_id, {BASE} as base, case when {PATH} = '' then '/' else regexp_replace({PATH}, '[^/]*$', '') end as dir from pages)
select page_id, base || '/list/' || page_id || '.html' as rooted, case page_id % 3 when 0 then 'https://x.example.com/a?b=1' when 1 then base || dir || 'next.html' else base || case when dir = '/' then '/' else regexp_replace(dir, '[^/]+/$', '') end || 'up.html' end as mixed from p""")
def l1(t):
    k = F.col("page_id") % 3
    href = F.when(k == 0, " https://x.example.com/a?b=1").when(k == 1, "next.html").otherwise("../up.html")
    return t.pages.select("page_id", urls.absolute_url("url", F.concat(F.lit("/list/"), F.col("page_id"), F.lit(".html"))).alias("rooted"), urls.absolute_url("url", href).alias("mixed"))


@query("l2_asset_url", f"""
select page_id, case page_id % 4 when 0 then '' when 1 then '' when 2 then url else 'https://cdn.example.com/' || substr({PATH}, 2) end as asset from pages""")
def l2(t):
    k = F.col("page_id") % 4
    raw = F.when(k == 0, " ").when(k == 1, F.concat("url", F.lit("/default.png"))).when(k == 2, F.concat(F.lit(" "), "url")).otherwise(urls.url_path("url"))
    return t.pages.select("page_id", urls.asset_url(raw, "https://cdn.example.com", "default.png").alias("asset"))


@query("l3_url_id", r"""
select page_id, regexp_extract(url, '/([a-z]{2})/\d+', 1) as section, regexp_extract(url, '/(\d+)(?:\.html|/)?(?:[?#]|$)', 1) as id, regexp_extract(url, '[?&]page=([^&#]*)', 1) as page,
  case when url like '%ref=%' then regexp_extract(url, '[?&]ref=([^&#]*)', 1) else regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) end as origin from pages""")
def l3(t):
    return t.pages.select("page_id", urls.url_id("url", r"/([a-z]{2})/\d+").alias("section"), urls.url_id("url", r"/(\d+)(?:\.html|/)?(?:[?#]|$)").alias("id"),
                          urls.url_param("url", "page").alias("page"), urls.first_param("url", ["ref", "utm_source"]).alias("origin"))


@query("l4_prefix_category", """
select page_id, case regexp_extract(url, '^https?://([^/.]*)', 1) when 'www' then '主站' when 'm' then '移动' when 'blog' then '博客' else '' end as category from pages""")
def l4(t):
    host = urls.url_host("url")
    return t.pages.select("page_id", urls.prefix_category(host, {"www": "主站", "m": "移动", "blog": "博客"}, ".").alias("category"))


@query("l5_expand_pages", """
with c as (select o_custkey, greatest(ceil(count(*) / 3.0), 1)::bigint as n from orders group by 1)
select o_custkey, p as page, 'http://e.example.com/list/' || o_custkey || '/' || case when p = 1 then '' else 'page' || p || '/' end as url from c, unnest(generate_series(1, n)) u(p)""")
def l5(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("total"))
    pages = counts.select("o_custkey", F.explode(F.sequence(F.lit(1).cast("bigint"), urls.page_count(F.col("total"), 3))).alias("page"))
    base = F.concat(F.lit("http://e.example.com/list/"), F.col("o_custkey"), F.lit("/"))
    return pages.select("o_custkey", "page", urls.page_url(base, F.col("page")).alias("url"))


@query("l5_page_url_html", "select page_id, 'http://e.example.com/l' || page_id || case when page_id % 9 <= 1 then '.html' else 'p' || page_id % 9 || '.html' end as url from pages")
def l5_html(t):
    base = F.concat(F.lit("http://e.example.com/l"), F.col("page_id"))
    return t.pages.select("page_id", urls.page_url(base, F.col("page_id") % 9, "p{}.html").alias("url"))


@query("l6_page_count", """
select o_custkey, greatest(ceil(sum(case when o_orderstatus = 'F' then 1 else 0 end) / 4.0), 1)::bigint as pages, case when o_custkey % 2 = 0 then count(*) else 1 end as stated from orders group by 1""")
def l6(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count("*").alias("n"))
    text = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("<em>共 "), F.col("n"), F.lit(" 页</em>"))).otherwise("no pager")
    return counts.select("o_custkey", urls.page_count(F.col("f"), 4).alias("pages"), urls.page_count_from_text(text, r"共\s*(\d+)\s*页").alias("stated"))


@query("l7_site_url", "select page_id, case when page_id % 5 = 0 then '' else regexp_replace(url, '^https://', 'http://') || case when ends_with(url, '/') then '' else '/' end end as site from pages")
def l7(t):
    return t.pages.select("page_id", urls.site_url(F.when(F.col("page_id") % 5 == 0, "　").otherwise(F.col("url"))).alias("site"))


@query("l8_object_key", f"""
select page_id, 'avatars/' || page_id || case when regexp_extract({PATH}, '[^/.][^/]*([.][^./]*)$', 1) <> '' then regexp_extract({PATH}, '[^/.][^/]*([.][^./]*)$', 1) when page_id % 3 = 0 then '.png' else '.jpg' end as key from pages""")
def l8(t):
    mime = F.when(F.col("page_id") % 3 == 0, "Image/PNG; q=1").when(F.col("page_id") % 3 == 1, "image/jpeg").otherwise("")
    return t.pages.select("page_id", urls.object_key(F.col("page_id"), F.col("url"), mime, "/avatars/").alias("key"))


@query("l9_canonical_request", """
select page_id, '{"url":"' || url || '"' || case page_id % 3 when 0 then ',"method":"POST"' else '' end || case when page_id % 2 = 0 then ',"meta":{"page_id":' || page_id || '}' else '' end || '}' as request from pages""")
def l9(t):
    method = F.when(F.col("page_id") % 3 == 0, "post").when(F.col("page_id") % 3 == 1, "")
    meta = F.when(F.col("page_id") % 2 == 0, F.struct("page_id"))
    return t.pages.select("page_id", urls.canonical_request(F.col("url"), method, meta).alias("request"))


@query("l10_set_query_param", r"""
select page_id, regexp_replace(regexp_extract(url, '^([^#]*)', 1), '\?.*$', '') || '?' || case when url like '%page=2&ref=x%' then 'page=7&ref=x&ClassId=c+' || page_id when url like '%utm_source=feed%' then 'utm_source=feed&page=7&ClassId=c+' || page_id else 'page=7&ClassId=c+' || page_id end || regexp_extract(url, '(#.*)$', 1) as url from pages""")
def l10(t):
    values = {"page": F.lit("7"), "ClassId": F.concat(F.lit(" c "), F.col("page_id")), "none": F.lit("  ")}
    return t.pages.select("page_id", urls.set_query_param("url", values).alias("url"))


@query("d1_iso_date", """
select o_orderkey, case o_orderkey % 5 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%Y-%m-%d') when 2 then strftime(o_orderdate, '%Y/%m/%d') when 3 then '' else '2024-02-30' end as day from orders""")
def d1(t):
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, F.date_format("o_orderdate", " yyyy-M-d")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss　")).when(k == 2, F.date_format("o_orderdate", "yyyy/MM/dd "))
           .when(k == 3, " ").otherwise("2024-02-30"))
    return t.orders.select("o_orderkey", dates.iso_date(raw).alias("day"))


@query("d2_month_text", """
select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m') when 1 then strftime(o_orderdate, '%Y') when 2 then o_orderpriority else '' end as month from orders""")
def d2(t):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.date_format("o_orderdate", "'at 'yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "yyyy.M")).when(k == 2, F.concat(F.lit(" "), F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", dates.month_text(raw).alias("month"))


@query("d3_trim_seconds", "select event_id, case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%d %H:%M') else regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), ':00$', '') end as at from events")
def d3(t):
    raw = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd  HH:mm:'00'")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", dates.trim_seconds(raw).alias("at"))


@query("d4_find_date", "select o_orderkey, '1997-05-28 10:20:00' as published from orders")
def d4(t):
    return t.orders.select("o_orderkey", dates.find_date(F.expr(NOTICE)).alias("published"))


@query("d4_find_date_in_documents", r"select doc_id, regexp_extract(text, '(\d{4}[/-]\d{2}[/-]\d{2}(?:\s+\d{2}:\d{2}(?::\d{2})?)?)', 1) as first_date from documents")
def d4_documents(t):
    return t.documents.select("doc_id", dates.find_date("text").alias("first_date"))
