"""Ordinals, states, sorts and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.operators import ledger as lg
from harvestry.operators import ordering as od
from harvestry.operators import sets
from harvestry.plans.registry import query

STATES = "case {c} when 'view' then 'pending' when 'click' then 'queued' when 'signup' then 'running' when 'error' then 'waiting_retry' else 'done' end"


def state(column: str):
    return F.expr(STATES.format(c=column))


@query("w1_record_ordinal", "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as ordinal from orders")
def w1(t):
    return od.global_ordinal(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "ordinal")


@query("w2_rank_labels", """
with r as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() over (partition by l_orderkey % 500 order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem)
select l_orderkey % 500 as bundle, rn as ordinal, coalesce(['第一','第二','第三','第四','第五','第六','第七','第八','第九','第十'][rn], '第' || rn) || '候选人：P' || l_partkey as label from r""")
def w2(t):
    lines = t.lineitem.select((F.col("l_orderkey") % 500).alias("bundle"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    ranked = od.group_ordinal(lines, ["bundle"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return ranked.select("bundle", "ordinal", lg.rank_label(F.col("ordinal"), F.concat(F.lit("P"), F.col("l_partkey"))).alias("label"))


@query("w2_rank_label_list", """
select c_custkey, '第一候选人：' || c_name || '|第二候选人：' || c_mktsegment as labels from customer""")
def w2_list(t):
    return t.customer.select("c_custkey", F.array_join(lg.rank_labels(F.array(F.concat(F.lit(" "), F.col("c_name")), F.col("c_mktsegment"))), "|").alias("labels"))


@query("w3_transition_check", f"""
with h as (select user_id, event_id, {STATES.format(c='event_type')} as status from events),
p as (select *, lag(status) over (partition by user_id order by event_id) as previous_status from h)
select user_id, event_id, status, previous_status from p where previous_status is not null and not (
  (previous_status = 'pending' and status = 'queued') or (previous_status = 'queued' and status in ('running', 'waiting_retry')) or
  (previous_status = 'running' and status in ('done', 'waiting_retry')) or (previous_status = 'waiting_retry' and status = 'queued'))""")
def w3(t):
    history = t.events.select("user_id", "event_id", state("event_type").alias("status"))
    return lg.transition_check(history, "user_id", ["event_id"], "status")


@query("w4_latest_status", f"select user_id, max(event_id) as event_id, arg_max({STATES.format(c='event_type')}, event_id) as status from events group by 1")
def w4(t):
    return lg.latest_status(t.events.select("user_id", "event_id", state("event_type").alias("status")), "user_id", ["event_id"])


ORDER_STATE = "case o_orderstatus when 'O' then case o_orderkey % 4 when 0 then 'pending' when 1 then 'queued' when 2 then 'running' else 'blocked' end when 'F' then 'done' else case o_orderkey % 2 when 0 then 'failed' else 'waiting_retry' end end"


@query("w5_unfinished", f"""
select o_orderkey, o_orderdate, status from (select o_orderkey, o_orderdate, {ORDER_STATE} as status from orders) where status not in ('done', 'failed', 'cancelled') order by o_orderdate, o_orderkey""")
def w5(t):
    return lg.unfinished(t.orders.select("o_orderkey", "o_orderdate", F.expr(ORDER_STATE).alias("status")), "status", ["o_orderdate", "o_orderkey"])


@query("w6_recover", f"""
with s as (select o_orderkey, {ORDER_STATE} as status from orders)
select o_orderkey, 'queue' as what, 0 as step, 'queued' as new_status from s where status not in ('done', 'failed', 'cancelled')
union all select o_orderkey, 'history', 0, case when status = 'running' then 'waiting_retry' else 'queued' end from s where status in ('running', 'pending', 'waiting_retry', 'blocked')
union all select o_orderkey, 'history', 1, 'queued' from s where status = 'running'""")
def w6(t):
    queued, history = lg.recover(t.orders.select("o_orderkey", F.expr(ORDER_STATE).alias("status")), "o_orderkey", "status")
    out = queued.select("o_orderkey", F.lit("queue").alias("what"), F.lit(0).alias("step"), F.col("status").alias("new_status"))
    return out.unionByName(history.select("o_orderkey", F.lit("history").alias("what"), "step", "new_status"))


@query("o1_name_order", """
with n as (select p_partkey, case p_partkey % 4 when 0 then p_partkey || p_name when 1 then '中' || p_name else p_name end as name from part)
select p_partkey, name, row_number() over (order by regexp_matches(name, '^[0-9]'), not regexp_matches(name, '^[\\x{4e00}-\\x{9fff}]'), name, p_partkey) as place from n""".replace("\\\\", "\\"))
def o1(t):
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.concat(F.col("p_partkey"), F.col("p_name"))).when(k == 1, F.concat(F.lit("中"), F.col("p_name"))).otherwise(F.col("p_name"))
    # Range-partitioned on the sort keys themselves, so the positions cost no single-task sort.
    keyed = t.part.select("p_partkey", name.alias("name")).withColumns({"a": F.col("name").rlike(r"^\d"), "b": ~F.col("name").rlike(r"^[\x{4e00}-\x{9fff}]")})
    return od.global_ordinal(keyed, ["a", "b", "name", "p_partkey"], "place").select("p_partkey", "name", "place")


@query("o2_top_k_candidates", """
select event_id, value from events where event_type = 'click' and user_id % 2 = 0 and (upper(props) like '%"K": 1%' or upper(props) like '%"K": 7%') order by value, props, event_id limit 10""")
def o2(t):
    fit = (F.col("event_type") == "click") & (F.col("user_id") % 2 == 0)
    return od.top_k(t.events, fit, ['"k": 1', '"k": 7'], F.col("props"), [F.col("value"), F.col("props"), F.col("event_id")], 10).select("event_id", "value")


@query("o3_cap", "select page_id, url from pages order by page_id limit 25")
def o3(t):
    return od.cap(t.pages.select("page_id", "url"), ["page_id"], 25)


@query("o4_stop_rule", """
with p as (select o_custkey % 50 as series, o_orderkey // 200 as page, count(*) filter (o_orderstatus <> 'P') as n from orders group by 1, 2),
s as (select series, min(case when n = 0 then page end) as e, min(case when n < 2 then page end) as sh, min(case when page >= greatest(ceil(90.0 / 2), 1) then page end) as l from p group by 1)
select p.series, p.page, p.n as n_rows from p join s using (series) where (least(e - 1, sh, l) is null or page <= least(e - 1, sh, l)) and n > 0""")
def o4(t):
    pages = t.orders.groupBy((F.col("o_custkey") % 50).alias("series"), F.expr("o_orderkey div 200").alias("page")).agg(F.count_if(F.col("o_orderstatus") != "P").alias("n_rows"))
    return od.stop_rule(pages.withColumn("total", F.lit(90)), ["series"], "page", "n_rows", 2, "total").drop("total")


@query("u1_union_distinct", "select c_nationkey as k from customer union select s_nationkey from supplier")
def u1(t):
    return sets.union_distinct(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"))


@query("u2_except_done", "select c_name from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000) order by c_name")
def u2(t):
    done = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return sets.except_done(t.customer, done, ["c_custkey"], ["c_name"]).select("c_name")


@query("u3_ack", "select user_id, event_type from events group by 1, 2 having count(*) filter (value > 60) = 0")
def u3(t):
    return sets.ack(t.events, t.events.filter("value > 60"), ["user_id", "event_type"])


@query("u4_concat_dedupe", """
with l as (select page_id, ['/top', '/The'] || regexp_extract_all(html, 'href="([^"]*)"', 1) as links from pages)
select page_id, array_to_string(list_transform(list_filter(generate_series(1, len(links)), lambda i: list_position(links, links[i]) = i), lambda i: links[i]), ' ') as links from l""")
def u4(t):
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    both = sets.concat_dedupe(F.array(F.lit("/top"), F.lit("/The")), found)
    return t.pages.select("page_id", F.array_join(both, " ").alias("links"))
