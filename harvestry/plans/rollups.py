"""Aggregates on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions.text import any_contains, strip_edge_noise
from harvestry.operators import ordering as od
from harvestry.operators import rollups as ru
from harvestry.plans.registry import query


def holds_part_word(name):
    text = strip_edge_noise(name)
    return (F.length(text) >= 2) & any_contains(text, ["ring", "bolt", "widget"])


@query("a1_clean_candidates", """
select distinct p_name as name from part where p_name like '%ring%' or p_name like '%bolt%' or p_name like '%widget%'""")
def a1(t):
    return ru.clean_candidates(t.part.select(F.concat(F.lit("★ "), F.col("p_name"), F.lit("。")).alias("p_name")), "p_name", holds_part_word)


@query("a1_candidate_summary", """
with m as (select *, (p_name like '%ring%' or p_name like '%bolt%' or p_name like '%widget%') as ok from part),
s as (select p_partkey, p_name from m where not ok order by p_partkey limit 20)
select count(*) as raw_count, count(distinct case when ok then p_name end) as candidate_count, count(*) filter (not ok) as filtered_count,
  count(*) filter (ok) - count(distinct case when ok then p_name end) as merged_count, (select string_agg(p_partkey || ':' || p_name, ',' order by p_partkey) from s) as samples from m""")
def a1_summary(t):
    out = ru.candidate_summary(t.part, "p_name", ["p_partkey"], holds_part_word)
    shown = F.array_join(F.transform("filtered_examples", lambda e: F.concat_ws(":", e.p_partkey.cast("string"), e.normalized)), ",")
    return out.withColumn("samples", shown).drop("filtered_examples")


@query("a2_merge_fill", """
select user_id, arg_min(event_type, event_id) filter (event_id % 3 = 0) as name, arg_min(props, event_id) filter (event_id % 2 = 0) as props, arg_min(value, event_id) as value
from events group by user_id having arg_min(event_type, event_id) filter (event_id % 3 = 0) is not null""")
def a2(t):
    df = t.events.select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("　").alias("name"),
                         F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("props"), "value")
    return ru.merge_fill(df, "user_id", ["event_id"], ["name", "props", "value"], ["name"])


MEMBER = """case page_id % 8 when 0 then url when 1 then '{"url": "' || url || '"}' when 2 then '"' || url || '"' when 3 then '{"url": " "}' when 4 then '[1]' when 5 then '  '
  when 6 then '{"url": "http://same.example.com/"}' else 'NaN' end"""


@query("a3_migration_plan", """
select count(*) as total, count(distinct case when k = 0 or k = 1 or k = 2 then url when k = 6 then 'http://same.example.com/' end) as "unique", count(*) filter (k = 0) as legacy,
  count(*) filter (k in (1, 2, 6)) as json, count(*) filter (k in (3, 4, 5, 7)) as invalid,
  count(*) - count(distinct case when k = 0 or k = 1 or k = 2 then url when k = 6 then 'http://same.example.com/' end) - count(*) filter (k in (3, 4, 5, 7)) as duplicate
from (select url, page_id % 8 as k from pages)""")
def a3(t):
    return ru.migration_plan(t.pages.select(F.expr(MEMBER).alias("member")), "member")


@query("a4_keep_first", """
select o_custkey, arg_min(o_orderkey, o_orderkey) as o_orderkey, arg_min(o_orderstatus, o_orderkey) as o_orderstatus from orders where o_custkey % 11 <> 0 group by 1""")
def a4(t):
    keyed = t.orders.select(F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_orderstatus")
    return od.keep_first(keyed, ["o_custkey"], ["o_orderkey"], drop_blank=True)


@query("a5_run_summary", """
select count(*) as raw_count, count(distinct o_custkey) filter (o_totalprice > 50000) as unique_count,
  count(*) - count(distinct o_custkey) filter (o_totalprice > 50000) - count(*) filter (o_totalprice <= 50000) as duplicate_count,
  count(distinct o_custkey) filter (o_totalprice > 50000) as upserted_count, count(*) filter (o_totalprice <= 50000) as skipped_invalid, max(o_orderkey // 100) as last_page from orders""")
def a5(t):
    return ru.run_summary(t.orders.withColumn("page", F.expr("o_orderkey div 100")), "o_custkey", "page", F.col("o_totalprice") > 50000)


@query("a6_monitor_status", """
with r as (select user_id % 7 as city, event_type, user_id % 3 as web, event_id // 97 as run, case event_type when 'error' then case when event_id % 2 = 0 then 'list_failed' else 'detail_failed' end
    when 'view' then 'has_content' when 'click' then 'has_new_data' when 'signup' then 'invalid_data' else 'other' end as kind, ts from events),
f as (select city, web, run, min(case when kind in ('list_failed', 'detail_failed') then 0 else 1 end) as "WasSuccessful", min(case when kind in ('list_failed', 'detail_failed') then 0 else 1 end) as "WebsiteError",
    max(case when kind = 'has_content' then 1 else 0 end) as "HasContent", max(case when kind = 'has_new_data' then 1 else 0 end) as "HasNewData",
    min(case when kind in ('invalid_data', 'detail_failed') then 0 else 1 end) as "IsValidData", max(ts) as flushed_at from r group by 1, 2, 3)
select city, web, run, "WasSuccessful", "WebsiteError", "HasContent", "HasNewData", "IsValidData" from f
qualify row_number() over (partition by city, web order by flushed_at desc, run desc) = 1""")
def a6(t):
    kind = (F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), "list_failed").when(F.col("event_type") == "error", "detail_failed")
            .when(F.col("event_type") == "view", "has_content").when(F.col("event_type") == "click", "has_new_data").when(F.col("event_type") == "signup", "invalid_data").otherwise("other"))
    log = t.events.select((F.col("user_id") % 7).alias("city"), (F.col("user_id") % 3).alias("web"), F.expr("event_id div 97").alias("run"), "ts", kind.alias("kind"))
    return ru.monitor_status(log, ["city", "web"], "run", "ts", "kind").drop("flushed_at")


@query("a7_count_by_group", """
select case when grouping(event_type) = 0 then 'type' when grouping(m) = 0 then 'module' else 'all' end as level, m as module, event_type as kind, count(*) as n
from (select 'm' || (user_id % 4) as m, event_type from events) group by grouping sets ((m, event_type), (m), ())""")
def a7(t):
    return ru.count_by_group(t.events.select(F.concat(F.lit("m"), F.col("user_id") % 4).alias("m"), "event_type"), "m", "event_type")


@query("a8_status_counts", "select case o_orderstatus when 'F' then 'resolved' when 'O' then 'unresolved' else 'skipped' end as status, count(*) as n from orders group by 1")
def a8(t):
    status = F.when(F.col("o_orderstatus") == "F", "resolved").when(F.col("o_orderstatus") == "O", "unresolved").otherwise("skipped")
    return ru.status_counts(t.orders, status)


@query("a9_max_page", r"""
select page_id, greatest(coalesce(list_max(list_transform(regexp_extract_all(html || '<a href="/x/page' || page_id % 50 || '/">', 'href="[^"]*/page(\d+)/?"', 1), lambda x: cast(x as bigint))), 1), 1) as pages from pages""")
def a9(t):
    html = F.concat("html", F.lit('<a href="/x/page'), F.col("page_id") % 50, F.lit('/">'))
    return t.pages.select("page_id", ru.max_page(html, r'href="[^"]*/page(\d+)/?"').alias("pages"))


@query("a10_attempt_log", "select user_id, event_id, event_type from events order by 1, 2")
def a10(t):
    return ru.attempt_log(t.events.select("user_id", "event_id", "event_type"), "user_id", ["event_id"])


@query("a11_checkpoints_as_map", """
with l as (select user_id, event_type, arg_max(value, event_id) as v from events group by 1, 2)
select user_id, string_agg(event_type || '=' || printf('%.2f', v), ';' order by event_type) as checkpoints from l group by 1""")
def a11(t):
    maps = ru.checkpoints_as_map(t.events, "user_id", "event_type", "value", ["event_id"])
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("checkpoints")), lambda e: F.concat_ws("=", e.key, F.format_string("%.2f", e.value))), ";")
    return maps.select("user_id", shown.alias("checkpoints"))


@query("a11_checkpoint_pieces", """
with l as (select user_id, event_id // 7 as k, arg_max(value, event_id) as v from events group by 1, 2),
n as (select *, (row_number() over (partition by user_id order by k) - 1) // 4 as piece from l)
select user_id, piece, min(k) as first_key, count(*) as n_keys, string_agg(k || '=' || printf('%.2f', v), ';' order by k) as checkpoints from n group by 1, 2""")
def a11_pieces(t):
    pieces = ru.checkpoint_pieces(t.events.withColumn("k", F.expr("event_id div 7")), "user_id", "k", "value", ["event_id"], size=4)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("checkpoints")), lambda e: F.concat_ws("=", e.key.cast("string"), F.format_string("%.2f", e.value))), ";")
    return pieces.select("user_id", "piece", "first_key", "n_keys", shown.alias("checkpoints"))


@query("a12_new_members", "select distinct user_id from events where event_type = 'purchase' and user_id not in (select user_id from events where event_type = 'error' and value > 60)")
def a12(t):
    return ru.new_members(t.events.filter("event_type = 'purchase'"), t.events.filter("event_type = 'error' and value > 60"), "user_id")


@query("a12_new_member_count", "select count(distinct user_id) as added from events where event_type = 'purchase' and user_id not in (select user_id from events where event_type = 'error' and value > 60)")
def a12_count(t):
    return ru.new_members(t.events.filter("event_type = 'purchase'"), t.events.filter("event_type = 'error' and value > 60"), "user_id").agg(F.count("*").alias("added"))
