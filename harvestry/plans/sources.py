"""Readers and writers on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import jsonx
from harvestry.plans.registry import query
from harvestry.session import scratch_path
from harvestry.sources import readers, writers


@query("s1_read_records", "select event_id, event_type, user_id from events")
def s1(t):
    path = scratch_path(t.spark, "records") + ".jsonl"
    t.events.select(F.to_json(F.struct("event_id", "event_type", "user_id"))).write.text(path)
    rec = F.col("record")
    return readers.read_records(t.spark, path).select(
        jsonx.get_path(rec, "event_id", "bigint").alias("event_id"), jsonx.get_path(rec, "event_type", "string").alias("event_type"),
        jsonx.get_path(rec, "user_id", "bigint").alias("user_id"))


@query("s2_read_delimited", """
select cast(c_custkey as varchar) as "客户编号", c_name as "客户名称", c_mktsegment as "行业" from customer""")
def s2(t):
    path = scratch_path(t.spark, "gb18030")
    t.spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    padded = F.concat(F.lit("　"), F.col("c_name"), F.lit(" "))
    (t.customer.select(F.col("c_custkey").alias("客户编号"), padded.alias("客户名称"), F.col("c_mktsegment").alias("行业"), F.lit("x").alias(" "))
     .write.csv(path, header=True, encoding="GB18030"))
    return readers.read_delimited(t.spark, path)


@query("s3_read_seed_lines", "select distinct url from pages")
def s3(t):
    path = scratch_path(t.spark, "seeds")
    line = F.explode(F.array(F.concat(F.lit("  "), F.col("url"), F.lit("\t")), F.lit(""), F.col("url")))
    t.pages.select(line.alias("value")).write.text(path)
    return readers.read_seed_lines(t.spark, path)


@query("s4_read_pages", "select page_id, url, length(html) as html_chars from pages")
def s4(t):
    pages = readers.read_pages(t.spark, f"{t.folder}/pages.parquet", ["page_id", "url", "html"])
    return pages.select("page_id", "url", F.length("html").alias("html_chars"))


@query("s5_union_sources", """
select c_custkey as id, c_name as name, c_mktsegment as segment, 'customer' as dataset_name, 'cat-1' as catalog_id, 0 as dataset_order from customer
union all select s_suppkey, s_name, null, 'supplier', 'cat-2', 1 from supplier""")
def s5(t):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return readers.union_sources({"customer": (customers, "cat-1"), "supplier": (suppliers, "cat-2")})


@query("s6_parse_payload", """
select event_id, case when event_id % 5 <> 0 then cast(json_extract(props, '$.k') as bigint) end as k from events""")
def s6(t):
    payload = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    return t.events.select("event_id", jsonx.get_path(jsonx.parse_payload(payload), "k", "bigint").alias("k"))


@query("s7_parse_enveloped", """
select event_id, cast(json_extract(props, '$.k') as bigint) as total, case when event_id % 3 = 0 then 0 else 1 end as n_records,
  case when event_id % 3 <> 0 then event_type end as first_type from events""")
def s7(t):
    k = F.get_json_object("props", "$.k").cast("bigint")
    inner = F.to_json(F.struct(F.struct(F.array(F.struct("event_type")).alias("records"), k.alias("totalcount")).alias("result")))
    no_list = F.to_json(F.struct(F.struct(F.lit("none").alias("records"), k.alias("totalcount")).alias("result")))
    content = F.when(F.col("event_id") % 3 == 0, no_list).otherwise(inner)
    opened = t.events.select("event_id", jsonx.enveloped(F.to_json(F.struct(content.alias("content")))).alias("e"))
    return opened.select("event_id", "e.total", F.size("e.records").alias("n_records"),
                         jsonx.get_path(F.try_element_at("e.records", F.lit(1)), "event_type", "string").alias("first_type"))


@query("k1_upsert", """
with u as (
  select c_custkey + case when c_custkey % 4 = 0 then 1000000 else 0 end as c_custkey, c_name || '*' || r as c_name, c_nationkey, c_acctbal + r as c_acctbal, c_mktsegment, r
  from customer, (values (1), (2)) v(r) where c_acctbal < 5000),
last as (select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from u where r = 2)
select * from last union all select * from customer where c_custkey not in (select c_custkey from last)""")
def k1(t):
    two = t.customer.filter("c_acctbal < 5000").withColumn("r", F.explode(F.array(F.lit(1), F.lit(2))))
    updates = two.select((F.col("c_custkey") + F.when(F.col("c_custkey") % 4 == 0, 1000000).otherwise(0)).alias("c_custkey"),
                         F.concat_ws("*", "c_name", F.col("r").cast("string")).alias("c_name"), "c_nationkey",
                         (F.col("c_acctbal") + F.col("r")).alias("c_acctbal"), "c_mktsegment", "r")
    return writers.upsert(t.customer, updates, ["c_custkey"], ["r"])


@query("k2_route", """
select event_id, case when event_type = 'error' then 'failures' when event_type in ('purchase', 'signup') then 'records' else 'other' end as target from events""")
def k2(t):
    path = scratch_path(t.spark, "routed")
    rules = {"failures": F.col("event_type") == "error", "records": F.col("event_type").isin("purchase", "signup")}
    writers.write_routed(writers.route(t.events.select("event_id", "event_type"), rules), path)
    return t.spark.read.parquet(path).select("event_id", F.col("target").cast("string").alias("target"))


@query("k3_snapshot_manifest", """
select 'orders,customer' as sources, '1997-05-28' as target_date, count(*) as row_count from orders
where o_orderdate >= date '1997-05-28' and o_orderdate < date '1997-05-29'""")
def k3(t):
    from harvestry.operators.shaping import on_date

    path = scratch_path(t.spark, "snapshot")
    rows = on_date(t.orders, "o_orderdate", "1997-05-28").select("o_orderkey", "o_custkey", "o_totalprice")
    writers.write_snapshot(rows, path, ["orders", "customer"], target_date="1997-05-28")
    return t.spark.read.schema("target_date string, sources string, row_count bigint").json(f"{path}/manifest")


@query("k4_export_table", """
select cast(o_orderkey as varchar) as "订单编号", cast(o_custkey as varchar) as "客户编号", o_orderstatus as "状态",
  strftime(o_orderdate, '%Y-%m-%d') as "日期" from orders""")
def k4(t):
    path = scratch_path(t.spark, "export")
    layout = {"o_orderkey": "订单编号", "o_custkey": "客户编号", "o_orderstatus": "状态", "day": "日期"}
    writers.write_export(t.orders.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")), path, layout)
    return t.spark.read.schema("`订单编号` string, `客户编号` string, `状态` string, `日期` string").csv(path, header=True)


@query("k5_patch", """
select c_custkey, case when c_acctbal < 3000 then 'patched' else c_name end as c_name,
  case when c_acctbal < 3000 and c_custkey % 2 = 0 then 'SEG' when c_custkey % 2 = 0 then 'void 0' else c_mktsegment end as c_mktsegment,
  case when c_acctbal < 3000 then null else c_acctbal end as c_acctbal from customer""")
def k5(t):
    base = t.customer.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, "void 0").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal")
    patches = t.customer.filter("c_acctbal < 3000").select("c_custkey", F.lit("patched").alias("c_name"), F.lit("SEG").alias("c_mktsegment"))
    return writers.patch(base, patches, "c_custkey", ["c_name"], {"c_mktsegment": ["void 0"]}, ["c_acctbal"])


@query("k5_rename_legacy", """
select c_custkey, case when c_custkey % 2 = 0 then 'new' || c_custkey else c_name end as avatar,
  case when c_custkey % 2 = 0 and c_custkey % 5 <> 0 then c_name when c_custkey % 5 = 0 then 'kept' end as origin from customer""")
def k5_legacy(t):
    even = F.col("c_custkey") % 2 == 0
    df = t.customer.select("c_custkey", F.col("c_name").alias("avatar"), F.when(F.col("c_custkey") % 5 == 0, "kept").alias("origin"),
                           F.when(even, F.concat(F.lit("new"), F.col("c_custkey"))).alias("legacy"), F.lit("x").alias("helper"))
    return writers.rename_legacy(df, "avatar", "origin", "legacy", ["helper"])


@query("k6_safe_replace", "select distinct url from pages")
def k6(t):
    path = scratch_path(t.spark, "urls")
    t.pages.select("url").write.parquet(path)
    clean = t.spark.read.parquet(path).distinct()
    writers.safe_replace(clean, path, clean.count())
    return t.spark.read.parquet(path)
