"""Merges, lookups and resolution on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import text as tx
from harvestry.operators import joining as jn
from harvestry.plans.registry import query
from harvestry.specs import words


@query("j1_merge_detail", """
with d as (select o_custkey, max(o_orderpriority) as best, count(*) as n from orders group by 1)
select c_custkey, case when d.n % 2 = 0 then d.best else c_mktsegment end as c_mktsegment, c_name
from customer left join d on o_custkey = c_custkey""")
def j1(t):
    best = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("best"), F.count("*").alias("n"))
    details = best.select("c_custkey", F.when(F.col("n") % 2 == 0, F.col("best")).otherwise("").alias("c_mktsegment"), F.lit(None).cast("string").alias("c_name"))
    return jn.merge_detail(t.customer.select("c_custkey", "c_mktsegment", "c_name"), details, "c_custkey", ["c_mktsegment", "c_name"])


@query("j2_overlay", """
select s_suppkey, case when s_suppkey % 3 = 0 and s_acctbal < 5000 then s_name when s_suppkey % 3 = 0 then '' else 'detail ' || s_suppkey end as s_name,
  'd' as note from supplier where s_acctbal > 1000""")
def j2(t):
    base = t.supplier.filter("s_acctbal < 5000").select("s_suppkey", "s_name")
    over = t.supplier.filter("s_acctbal > 1000").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.concat(F.lit("detail "), F.col("s_suppkey"))).alias("s_name"), F.lit("d").alias("note"))
    return jn.overlay(base, over, "s_suppkey")


@query("j3_pending", """
select c_name from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 2 = 0 and o_custkey % 3 <> 0)
  and c_custkey not in (select o_custkey + 1 from orders where o_orderkey % 2 = 1 and o_custkey % 4 = 0)""")
def j3(t):
    return jn.pending(t.customer.select("c_name"), "c_name", processed(t), ["query_name", "entity_name"])


@query("j3_pending_counts", """
with d as (select o_custkey as k from orders where o_orderkey % 2 = 0 and o_custkey % 3 <> 0 union select o_custkey + 1 from orders where o_orderkey % 2 = 1 and o_custkey % 4 = 0)
select count(*) as candidates, count(*) filter (where c_custkey not in (select k from d)) as pending, count(*) filter (where c_custkey in (select k from d)) as skipped from customer""")
def j3_counts(t):
    return jn.pending_counts(t.customer.select("c_name"), "c_name", processed(t), ["query_name", "entity_name"])


def processed(t):
    """Two name columns, each filled on some rows only."""
    name = lambda key: F.concat(F.lit(" Customer#"), F.lpad(key.cast("string"), 9, "0"))
    return t.orders.select(F.when((F.col("o_orderkey") % 2 == 0) & (F.col("o_custkey") % 3 != 0), name(F.col("o_custkey"))).alias("query_name"),
                           F.when((F.col("o_orderkey") % 2 == 1) & (F.col("o_custkey") % 4 == 0), name(F.col("o_custkey") + 1)).otherwise(" ").alias("entity_name"))


@query("j4_resolve_entity", """
with ref as (select s_suppkey, case when s_suppkey % 4 = 0 then '总院' || s_suppkey when s_suppkey % 4 = 1 then '华东' || (s_suppkey % 10) || '分院' || (s_suppkey - 1)
    when s_suppkey % 4 = 2 then '北区中心' else '甲市第' || s_suppkey || '医院' end as ref_name from supplier),
q as (select c_custkey, case when c_custkey % 5 = 0 then '★总院' || (c_custkey % 40) when c_custkey % 5 = 1 then '分院' || (c_custkey % 40)
    when c_custkey % 5 = 2 then '中心' when c_custkey % 5 = 3 then '第' || (c_custkey % 60) || '医院' else '---' end as asked from customer),
k as (select *, replace(replace(asked, '★', ''), '-', '') as key from q),
ex as (select k.c_custkey, min(s_suppkey) as s from k join ref on ref_name = key where key <> '' group by 1),
sf as (select k.c_custkey, count(*) as n, min(s_suppkey) as s from k join ref on ref_name <> key and ends_with(ref_name, key) where key <> '' group by 1)
select k.c_custkey, k.asked, r.s_suppkey, r.ref_name, case when ex.s is not null then 'exact' when sf.n = 1 then 'suffix' else '' end as match_kind,
  case when ex.s is not null or sf.n = 1 then 'Y' else 'N' end as resolved
from k left join ex using (c_custkey) left join sf on sf.c_custkey = k.c_custkey
left join ref r on r.s_suppkey = coalesce(ex.s, case when sf.n = 1 then sf.s end)""")
def j4(t):
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    ref_name = (F.when(s % 4 == 0, F.concat(F.lit("总院"), s)).when(s % 4 == 1, F.concat(F.lit("华东"), s % 10, F.lit("分院"), s - 1))
                .when(s % 4 == 2, "北区中心").otherwise(F.concat(F.lit("甲市第"), s, F.lit("医院"))))
    asked = (F.when(c % 5 == 0, F.concat(F.lit("★总院"), c % 40)).when(c % 5 == 1, F.concat(F.lit("分院"), c % 40)).when(c % 5 == 2, "中心")
             .when(c % 5 == 3, F.concat(F.lit("第"), c % 60, F.lit("医院"))).otherwise("---"))
    return jn.resolve_entity(t.customer.select("c_custkey", asked.alias("asked")), "asked", t.supplier.select("s_suppkey", ref_name.alias("ref_name")), "ref_name", ["s_suppkey"])


@query("j5_resolve_exact", """
with r as (select 'NATION_' || (n_nationkey % 10) as nm, min(n_nationkey) as n_nationkey from nation group by 1)
select s_suppkey, r.nm as nation_name, r.n_nationkey from supplier left join r on r.nm = 'NATION_' || s_nationkey""")
def j5(t):
    ref = t.nation.select(F.concat(F.lit("NATION_"), F.col("n_nationkey") % 10).alias("nation_name"), "n_nationkey")
    asked = t.supplier.select("s_suppkey", F.concat(F.lit("* NATION_"), F.col("s_nationkey"), F.lit(" 。")).alias("asked"))
    return jn.resolve_exact(asked, "asked", ref, "nation_name", ["n_nationkey"]).drop("asked")


@query("j6_stitch_payloads", """
with a as (select c_custkey, c_name as nm, case when c_custkey % 2 = 0 then c_mktsegment else '' end as title from customer where c_acctbal > 2000),
o as (select o_custkey, count(*) as n_cards, min(o_orderpriority) as title from orders group by 1),
l as (select c_custkey, 'legacy ' || c_custkey as nm, n_name as avatar from customer join nation on n_nationkey = c_nationkey),
e as (select o_custkey, max(o_orderstatus) as ev from orders where o_orderstatus <> 'P' group by 1)
select c.c_custkey, coalesce(a.nm, l.nm, '') as name, coalesce(nullif(a.title, ''), o.title, '') as title, coalesce(l.avatar, a.nm, '') as avatar,
  coalesce(cast(o.n_cards as varchar), '') as cards, coalesce(e.ev, '') as events
from customer c left join a using (c_custkey) left join o on o.o_custkey = c.c_custkey left join l on l.c_custkey = c.c_custkey left join e on e.o_custkey = c.c_custkey""")
def j6(t):
    auth = t.customer.filter("c_acctbal > 2000").select("c_custkey", F.col("c_name").alias("nm"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("title"))
    cards = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_cards"), F.min("o_orderpriority").alias("title"))
    legacy = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.concat(F.lit("legacy "), F.col("c_custkey")).alias("nm"), F.col("n_name").alias("avatar"))
    events = t.orders.filter("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("ev"))
    fields = {"name": ["auth.nm", "legacy.nm"], "title": ["auth.title", "cards.title"], "avatar": ["legacy.avatar", "auth.nm"], "cards": ["cards.n_cards"], "events": ["events.ev"]}
    return jn.stitch(t.customer.select("c_custkey"), {"auth": auth, "cards": cards, "legacy": legacy, "events": events}, "c_custkey", fields)


@query("j7_fk_distinct", """
select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderkey % 4 = 3 and o_custkey <> 0)""")
def j7(t):
    keys = jn.fk_distinct(foreign_keys(t), "fk").select(F.col("fk").cast("bigint").alias("c_custkey"))
    return keys.join(t.customer, "c_custkey").select("c_custkey", "c_name")


@query("j7_fk_counts", "select count(*) as rows, count(*) filter (where o_orderkey % 4 <> 3 or o_custkey = 0) as skipped, count(distinct case when o_orderkey % 4 = 3 and o_custkey <> 0 then o_custkey end) as keys from orders")
def j7_counts(t):
    return jn.fk_counts(foreign_keys(t), "fk")


def foreign_keys(t):
    k = F.col("o_orderkey") % 4
    return t.orders.select(F.when(k == 0, "0").when(k == 1, " None ").when(k == 2, "").otherwise(F.col("o_custkey").cast("string")).alias("fk"))


@query("j8_done_gate", """
select event_id, user_id, 'detail' as stage from events where event_id % 9 <> 0
union all select event_id, user_id, 'home' from events where event_id % 9 <> 0 and user_id not in (select user_id from events where event_type = 'error')""")
def j8(t):
    tasks = t.events.select("event_id", F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("user_id"))
    done = t.events.filter("event_type = 'error'").select("user_id")
    detail, home = jn.done_gate(tasks, "user_id", done)
    return detail.withColumn("stage", F.lit("detail")).unionByName(home.withColumn("stage", F.lit("home")))


@query("j9_two_source_entity", """
select s_suppkey, case when s_suppkey % 2 = 0 then s_name else 'fallback' end as name, case when s_nationkey % 2 = 0 then n_name else 'info' end as intro,
  case when s_suppkey % 3 = 0 then '城西区' when s_suppkey % 3 = 1 then '宁州市' else n_name end as area
from supplier left join nation on n_nationkey = s_nationkey""")
def j9(t):
    k = F.col("s_suppkey")
    info = t.supplier.select("s_suppkey", "s_nationkey", F.when(k % 2 == 0, F.col("s_name")).alias("plat_name"), F.lit("").alias("own_name"),
                             F.when(k % 3 == 0, "东省宁州市城西区一路").when(k % 3 == 1, "宁州市大街").otherwise("no tokens").alias("address"))
    overview = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("detail"), F.col("n_name").alias("city"))
    both = info.join(overview, "s_nationkey", "left")
    return both.select("s_suppkey", tx.first_non_empty("plat_name", "own_name", F.lit("fallback")).alias("name"), tx.first_non_empty("detail", F.lit("info")).alias("intro"),
                       tx.guess_area(F.col("address"), F.lit("医院"), F.col("city")).alias("area"))


@query("j10_attach_by_id", """
with links as (select page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">', 1)) as slug, generate_subscripts(regexp_extract_all(html, '<a href="/([^"]*)">', 1), 1) as pos from pages),
texts as (select page_id, unnest(regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1)) as label, generate_subscripts(regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1), 1) as pos from pages)
select l.page_id, l.slug, arg_max(t.label, t.pos) as label from (select distinct page_id, slug from links) l
join links k on k.page_id = l.page_id and k.slug = l.slug join texts t on t.page_id = k.page_id and t.pos = k.pos group by 1, 2""")
def j10(t):
    slugs = t.pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), 1)).alias("pos", "slug"))
    labels = t.pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">([^<]*)</a>'), 0)).alias("pos", "anchor"))
    extra = labels.select("page_id", F.regexp_extract("anchor", '<a href="/([^"]*)">', 1).alias("slug"), F.regexp_extract("anchor", ">([^<]*)<", 1).alias("label"), "pos")
    return jn.attach_by_id(slugs.select("page_id", "slug").distinct(), extra, ["page_id", "slug"])


@query("j11_code_lookup", """
select n_nationkey, case when r_regionkey < 3 then r_name else 'other' end as region_name,
  case n_nationkey % 4 when 1 then '三' when 2 then '二' when 3 then '一' else '' end || case n_regionkey when 2 then '甲' when 3 then '乙' when 4 then '丙' else '' end as level_text
from nation left join region on r_regionkey = n_regionkey""")
def j11(t):
    table = t.region.filter("r_regionkey < 3").select("r_regionkey", "r_name")
    out = jn.code_lookup(t.nation, "n_regionkey", table, "region_name", "other")
    level = tx.mapped((F.col("n_nationkey") % 4).cast("string"), words.LEVEL_TEXT, F.lit(""))
    grade = tx.mapped(F.col("n_regionkey").cast("string"), words.GRADE_TEXT, F.lit(""))
    return out.select("n_nationkey", "region_name", F.concat(level, grade).alias("level_text"))


@query("j12_expand_chain", """
select r_name, n_name, c_custkey, c_name, o_orderkey from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey
join orders on o_custkey = c_custkey where n_nationkey % 7 <> 0 and c_custkey % 5 <> 0""")
def j12(t):
    nations = t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"), F.when(F.col("n_nationkey") % 7 != 0, F.col("n_name")).alias("n_name"))
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).otherwise(" ").alias("c_name"))
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    level1 = jn.expand_level(t.region, nations, "r_regionkey", "n_nationkey", "n_name")
    level2 = jn.expand_level(level1, customers, "n_nationkey", "c_custkey", "c_name")
    return jn.expand_level(level2, orders, "c_custkey", "o_orderkey", "o_orderkey").select("r_name", "n_name", "c_custkey", "c_name", "o_orderkey")


@query("j13_expert_children", """
select n_nationkey, n_name, s_name as child_name, 'hospital_' || n_nationkey || '_' || replace(s_name, '#', '_') as child_id
from supplier join nation on n_nationkey = s_nationkey""")
def j13(t):
    lists = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select("n_nationkey", "n_name", F.array("s_name", F.lit(" ")).alias("experts"))
    return jn.expert_children(lists, "n_nationkey", "n_name", "experts", "hospital")
