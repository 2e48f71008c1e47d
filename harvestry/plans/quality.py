"""Record checks on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions.jsonx import parse_payload
from harvestry.operators import quality as ql
from harvestry.plans.registry import query


def event_records(t):
    """Events as records: ``k`` missing on some rows, null on others."""
    k = F.get_json_object("props", "$.k")
    n = F.col("event_id") % 10
    body = (F.when(n == 0, F.lit("{}")).when(n == 1, F.lit('{"a":{"k":null}}')).when(n == 2, F.lit('{"a":{"k":"  "}}')).when(n == 3, F.lit('{"a":{"k":[]}}'))
            .when(n == 4, F.lit('{"a":{"k":0}}')).otherwise(F.concat(F.lit('{"entity_type":"'), F.col("event_type"), F.lit('","a":{"k":'), k, F.lit("}}"))))
    return t.wide("events").select("event_id", parse_payload(body).alias("record"))


@query("v1_require", "select event_id, 'missing' as issue, 'a.k' as field from events where event_id % 10 in (0, 1)")
def v1(t):
    return ql.validate(event_records(t), "record", "event_id", ql.Checks(require=["a.k"])).drop("rank")


@query("v2_non_empty", """
select event_id, case when event_id % 10 in (0, 1) then 'missing_non_empty' else 'empty' end as issue, 'a.k' as field from events where event_id % 10 in (0, 1, 2, 3)""")
def v2(t):
    return ql.validate(event_records(t), "record", "event_id", ql.Checks(non_empty=["a.k"])).drop("rank")


def order_records(t):
    """Orders keyed by an object whose key order varies, and by a status that is missing on some rows."""
    c, flip = F.col("o_custkey") % 40, F.col("o_orderkey") % 2 == 0
    key = F.when(flip, F.concat(F.lit('{"x":'), c, F.lit(',"y":1}'))).otherwise(F.concat(F.lit('{"y":1,"x":'), c, F.lit("}")))
    status = F.when(F.col("o_orderkey") % 9 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"')))
    return t.wide("orders").select("o_orderkey", parse_payload(F.concat(F.lit('{"id":'), key, F.lit(',"s":'), status, F.lit("}"))).alias("record"))


@query("v3_unique_by", """
select o_orderkey, 'key_incomplete' as issue, 'id,s' as field from orders where o_orderkey % 9 = 0
union all select o_orderkey, 'duplicate_key', 'id,s' from (select o_orderkey, row_number() over (partition by o_custkey % 40, o_orderstatus order by o_orderkey) as rn from orders where o_orderkey % 9 <> 0) where rn > 1""")
def v3(t):
    return ql.validate(order_records(t), "record", "o_orderkey", ql.Checks(unique_by=["id", "s"])).drop("rank")


@query("v4_min_records", "select count(*) as records, 1000000 as minimum, count(*) >= 1000000 as ok from orders")
def v4(t):
    return ql.min_records(t.orders, 1000000)


@query("v5_expect_entity_type", "select event_id, 'entity_type' as issue, 'entity_type' as field from events where event_id % 10 < 5 or event_type <> 'click'")
def v5(t):
    return ql.validate(event_records(t), "record", "event_id", ql.Checks(entity_type="click")).drop("rank")


@query("v6_validate", """
with i as (
  select event_id, 0 as r, 'entity_type' as issue from events where event_id % 10 < 5 or event_type <> 'click'
  union all select event_id, 1, 'missing' from events where event_id % 10 in (0, 1)
  union all select event_id, 2, case when event_id % 10 in (0, 1) then 'missing_non_empty' else 'empty' end from events where event_id % 10 in (0, 1, 2, 3)
  union all select event_id, 1000, 'key_incomplete' from events where event_id % 10 in (0, 1)
  union all select event_id, 1000, 'duplicate_key' from (select event_id, row_number() over (partition by case event_id % 10 when 2 then 'blank' when 3 then 'list' when 4 then '0' else json_extract_string(props, '$.k') end order by event_id) as rn
    from events where event_id % 10 > 1) where rn > 1)
select (select count(*) from events) as records, count(*) as issues, false as ok, greatest(count(*) - 50, 0) as more,
  (select string_agg(event_id || ':' || issue, ',' order by event_id, r, issue) from (select * from i order by event_id, r, issue limit 50)) as first_issues from i""")
def v6(t):
    checks = ql.Checks(require=["a.k"], non_empty=["a.k"], unique_by=["a.k"], entity_type="click")
    report = ql.validation_report(event_records(t), "record", "event_id", checks)
    shown = F.array_join(F.transform("first_issues", lambda e: F.concat_ws(":", e.event_id.cast("string"), e.issue)), ",")
    return report.withColumn("first_issues", shown)


@query("v7_page_overlap", """
with r as (select distinct event_id // 50 as page, user_id from events), s as (select a.page, count(*) as shared from r a join r b on b.page = a.page - 1 and b.user_id = a.user_id group by 1)
select page, count(*) as keys, coalesce(any_value(shared), 0) as shared from r left join s using (page) group by 1""")
def v7(t):
    return ql.page_overlap(t.wide("events").select(F.expr("event_id div 50").alias("page"), "user_id"), "page", "user_id")


@query("v7_coverage", """
select lang, count(*) as rows, count(distinct source) as keys, count(*) filter (trim(text) <> '') as text_filled, count(*) filter (doc_id % 3 <> 0) as note_filled, count(*) between 50 and 500 as plausible from documents group by 1""")
def v7_coverage(t):
    df = t.documents.withColumn("note", F.when(F.col("doc_id") % 3 != 0, "n").otherwise(" "))
    return ql.coverage(df, "lang", "source", ["text", "note"], 50, 500)


@query("v8_page_mismatch", """
select event_id, case when event_id % 6 in (0, 1) then 'error' else 'page_mismatch' end as retry_reason from events
where event_id % 6 in (0, 1) or (event_id % 6 > 2 and cast(json_extract(props, '$.k') as bigint) <> user_id)""")
def v8(t):
    n, k = F.col("event_id") % 6, F.get_json_object("props", "$.k")
    body = (F.when(n == 0, F.lit('{"code":4998}')).when(n == 1, F.lit('{"code":0,"msg":"系统错误"}')).when(n == 2, F.lit("{}"))
            .otherwise(F.concat(F.lit('{"code":0,"result":{"page":'), k, F.lit("}}"))))
    out = ql.page_mismatch(t.wide("events").select("event_id", "user_id", body.alias("body")), F.col("user_id"), parse_payload("body"), "result.page", 4998, "系统错误")
    return out.select("event_id", "retry_reason")
