"""Arrays, maps and JSON on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import jsonx as jx
from harvestry.functions.text import split_names
from harvestry.operators.fanout import explode_participants, fan_out_results
from harvestry.operators.trees import flatten_tree
from harvestry.plans.registry import query
from harvestry.specs import words


def text_of(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("g1_get_path", """
select event_id, cast(json_extract(props, '$.k') as bigint) as k, case when event_id % 2 = 0 then event_type end as nested, case when event_id % 2 = 0 then '1' else '0' end as by_key from events""")
def g1(t):
    even = F.col("event_id") % 2 == 0
    body = F.when(even, text_of('{"p":', F.col("props"), ',"a":[{"b":[0,"', F.col("event_type"), '"]}],"m":{"0":1}}')).otherwise(
        text_of('{"p":', F.col("props"), ',"a":{"b":null},"m":[0]}'))
    v = t.wide("events").select("event_id", jx.parse_payload(body).alias("v"))
    return v.select("event_id", jx.get_path(F.col("v"), "p.k", "bigint").alias("k"), jx.get_path(F.col("v"), "a.0.b.1", "string").alias("nested"), jx.get_path(F.col("v"), "m.0", "string").alias("by_key"))


def order_payloads(t):
    """One payload per order in the envelope shapes seen."""
    k, data = F.col("o_orderkey") % 5, text_of('{"status":"', F.col("o_orderstatus"), '"}')
    body = (F.when(k == 0, text_of('{"responseObject":{"responseData":', data, '},"data":1}')).when(k == 1, text_of('{"responseObject":null,"responseData":', data, "}"))
            .when(k == 2, text_of('{"responseData":"x","data":{"data_list":', data, "}}")).when(k == 3, text_of('{"data":[', data, "]}")).otherwise(text_of("{bad", data)))
    return t.wide("orders").select("o_orderkey", jx.parse_payload(body).alias("v"))


@query("g2_response_data", """
select o_orderkey, case o_orderkey % 5 when 2 then '{"data_list":{"status":"' || o_orderstatus || '"}}' when 3 then '[{"status":"' || o_orderstatus || '"}]' when 4 then '{}' else '{"status":"' || o_orderstatus || '"}' end as data,
  case when o_orderkey % 5 < 3 then o_orderstatus else '' end as status from orders""")
def g2(t):
    return order_payloads(t).select("o_orderkey", F.to_json(jx.response_data(F.col("v"))).alias("data"), jx.text_at(jx.detail_data(F.col("v")), "status").alias("status"))


@query("g3_records_of", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, cast(l_partkey as varchar) as id, 'S' || l_suppkey as name from lineitem where l_linenumber <> 4 and l_linenumber <> 5 and l_partkey <> 0""")
def g3(t):
    n = F.col("l_linenumber")
    row = text_of('{"id":', F.when(n == 4, F.lit('"0"')).otherwise(F.col("l_partkey").cast("string")), ',"groupName":"', F.when(n == 5, F.lit("全部")).otherwise(F.concat(F.lit("S"), F.col("l_suppkey"))), '"}')
    body = (F.when(n == 1, text_of('{"data":{"pageList":[', row, ',5]}}')).when(n == 2, text_of('{"data":{"items":[', row, ']}}'))
            .when(n == 3, text_of('{"responseData":[', row, ',null]}')).otherwise(text_of('{"responseObject":{"responseData":{"list":3,"data_list":[', row, ']}}}')))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.wide("lineitem").select(*keys, jx.parse_payload(body).alias("v")).select(*keys, F.explode(jx.records_of(F.col("v"))).alias("r"))
    read = rows.select(*keys, jx.text_at(F.col("r"), "id").alias("id"), jx.text_at(F.col("r"), "groupName").alias("name"))
    return read.filter(~F.col("id").isin("", "0") & (F.col("name") != "") & (F.col("name") != "全部"))


@query("g4_page_info", """
select o_orderkey, case when o_orderkey % 3 = 2 then 1 else o_custkey + 1 end as current_page_num, case when o_orderkey % 3 = 0 then 20 else 0 end as page_size, case when o_orderkey % 3 = 2 then 0 else o_orderkey + 1 end as total_count, o_orderkey % 3 = 0 as last_page from orders""")
def g4(t):
    k = F.col("o_orderkey") % 3
    info = text_of('{"currentPageNum":', F.col("o_custkey") + 1, ',"totalCount":', F.col("o_orderkey") + 1)
    body = (F.when(k == 0, text_of('{"responseData":{"pageInfo":', info, ',"pageSize":20,"lastPage":true}}}')).when(k == 1, text_of('{"responseData":[],"data":{"pageInfo":', info, ',"lastPage":false}}}')).otherwise("{}"))
    p = t.wide("orders").select("o_orderkey", jx.page_info(jx.parse_payload(body)).alias("p"))
    return p.select("o_orderkey", "p.current_page_num", "p.page_size", "p.total_count", "p.last_page")


@query("g5_pick_path", """
select o_orderkey, case o_orderkey % 4 when 0 then '{"n":' || o_custkey || '}' when 1 then '{"n":' || o_custkey || '}' when 2 then '{"n":' || o_custkey || '}' else '{}' end as picked from orders""")
def g5(t):
    k, inner = F.col("o_orderkey") % 4, text_of('{"n":', F.col("o_custkey"), "}")
    body = (F.when(k == 0, text_of('{"final_result":', inner, ',"result":[]}')).when(k == 1, text_of('{"result":[{"extract_result":', inner, "}]}"))
            .when(k == 2, text_of('{"result":{"extract_result":', inner, "}}")).otherwise('{"result":"text"}'))
    v = t.wide("orders").select("o_orderkey", jx.parse_payload(body).alias("v"))
    return v.select("o_orderkey", F.to_json(jx.pick_path(F.col("v"), ["final_result", "result.0.extract_result", "result.extract_result", "result"])).alias("picked"))


@query("g6_flatten_list", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, strftime(l_shipdate, '%Y-%m') as start_date, case when l_linenumber % 2 = 0 then 'U' || l_suppkey else 'O' || l_partkey end as organization from lineitem""")
def g6(t):
    unit = F.when(F.col("l_linenumber") % 2 == 0, text_of('"unit":" U', F.col("l_suppkey"), '",')).otherwise(text_of('"unit":"","occupation":"O', F.col("l_partkey"), '",'))
    body = text_of('{"occupationList":[{', unit, '"startTime":"', F.date_format("l_shipdate", "yyyy-MM-dd"), '"},{"unit":" ","startTime":null},7]}')
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    v = t.wide("lineitem").select(*keys, jx.parse_payload(body).alias("v"))
    rows = jx.flatten_list(jx.get_path(F.col("v"), "occupationList"), {"organization": ["unit", "occupation"], "start_date": ["startTime"], "end_date": ["endTime"]}, ["start_date", "end_date"])
    return v.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.organization", "r.start_date")


@query("g7_join_objects", "select c_custkey, c_name || ' ' || c_mktsegment || ',' || c_mktsegment as line from customer")
def g7(t):
    row = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    rows = F.array(row(F.concat(F.lit(" "), F.col("c_name")), F.col("c_mktsegment")), row(F.lit(" "), F.lit("")), row(F.lit(""), F.col("c_mktsegment")))
    return t.customer.select("c_custkey", jx.join_objects(rows, ["a", "b"]).alias("line"))


@query("g8_parse_tags", """
select p_partkey, case p_size % 3 when 0 then '三甲医院' when 1 then '一级' else '' end as level, case when p_size % 2 = 0 then '公立医院' else '' end as ownership, p_brand as kind from part""")
def g8(t):
    level = F.when(F.col("p_size") % 3 == 0, "，三级甲等").when(F.col("p_size") % 3 == 1, "、一级").otherwise("")
    tags = split_names(F.concat(F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, ",公立医院").otherwise(""), level, F.lit(","), F.col("p_type")))
    r = t.part.select("p_partkey", jx.parse_tags(tags, words.LEVEL_MARKERS, words.OWNERSHIP_WORDS, words.LEVEL_SYNONYMS).alias("r"))
    return r.select("p_partkey", "r.level", "r.ownership", "r.kind")


@query("g9_explode_participants", """
select o_orderkey, 'res ' || o_orderkey as resource_name, cast(o_custkey as varchar) as person_id, o_orderstatus as name, 'x' as company from orders where o_custkey <> 0
union all select o_orderkey, 'res ' || o_orderkey, 'alt' || o_custkey, '', o_orderpriority from orders""")
def g9(t):
    person = lambda a, b, n, c: F.struct(a.alias("customerId"), b.alias("doctorId"), n.alias("name"), c.alias("company"))
    people = F.array(person(F.col("o_custkey").cast("string"), F.lit(""), F.col("o_orderstatus"), F.lit("x")), person(F.lit(" "), F.concat(F.lit("alt"), F.col("o_custkey")), F.lit(None), F.col("o_orderpriority")),
                     person(F.lit("0"), F.lit("9"), F.lit("zero"), F.lit("")))
    resources = t.wide("orders").select("o_orderkey", F.concat(F.lit("res "), F.col("o_orderkey")).alias("resource_name"), people.alias("people"))
    return explode_participants(resources, "people", ["customerId", "doctorId"], {"name": ["name"], "company": ["company"]}, ["o_orderkey", "resource_name"])


@query("g10_flatten_tree", """
select 1000000 + r_regionkey as node, 0 as depth from region union all select 2000000 + n_nationkey, 1 from nation union all select 3000000 + s_suppkey, 2 from supplier where s_suppkey > 0""")
def g10(t):
    regions = t.region.select((F.col("r_regionkey") + 1000000).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("parent"))
    nations = t.nation.select((F.col("n_nationkey") + 2000000).cast("bigint").alias("node"), (F.col("n_regionkey") + 1000000).cast("bigint").alias("parent"))
    leaves = t.supplier.select(F.when(F.col("s_suppkey") > 0, F.col("s_suppkey") + 3000000).otherwise(F.col("s_suppkey")).alias("node"), (F.col("s_nationkey") + 2000000).cast("bigint").alias("parent"))
    tree = regions.unionByName(nations).unionByName(leaves).withColumn("place", F.col("node"))
    return flatten_tree(tree, "node", "parent", "place").select("node", "depth")


@query("g10_preorder", """
with n as (select r_regionkey as r, -1 as n, 1000000 + r_regionkey as node from region union all select n_regionkey, n_nationkey, 2000000 + n_nationkey from nation)
select node, row_number() over (order by r, n) as place from n""")
def g10_preorder(t):
    from harvestry.operators.ordering import global_ordinal

    regions = t.region.select((F.col("r_regionkey") + 1000000).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("parent"))
    nations = t.nation.select((F.col("n_nationkey") + 2000000).cast("bigint").alias("node"), (F.col("n_regionkey") + 1000000).cast("bigint").alias("parent"))
    flat = flatten_tree(regions.unionByName(nations).withColumn("place", F.col("node")), "node", "parent", "place")
    return global_ordinal(flat.select("node", "path"), ["path"], "place").select("node", "place")


@query("g11_strip_keys", "select p_partkey, 'name=' || p_name as kept, case when p_size % 2 = 0 then p_name else '' end as listed from part")
def g11(t):
    items = F.array(F.create_map(F.lit("包号"), F.col("p_brand"), F.lit("候选人名称"), F.col("p_type"), F.lit("name"), F.col("p_name")))
    show = F.array_join(F.transform(jx.strip_keys(items, ["包号", "候选人名称"]), lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e.key, e.value)), ";")), "|")
    return t.part.select("p_partkey", show.alias("kept"), F.array_join(jx.as_list(F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("")), "|").alias("listed"))


@query("g12_contact_struct", """
select c_custkey, '名称：' || c_name as purchasing, case when c_custkey % 2 = 0 then '项目联系人：' || c_mktsegment || '|' else '' end || '电话：' || c_custkey as project from customer""")
def g12(t):
    c = jx.contact_struct(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(""), F.col("c_custkey").cast("string"))
    return t.customer.select("c_custkey", c.alias("c")).select("c_custkey", F.array_join("c.purchasing", "|").alias("purchasing"), F.array_join("c.project", "|").alias("project"))


def result_items():
    item = lambda a, m: F.struct(a.alias("company"), m.alias("money"))
    two = F.array(item(F.concat(F.lit(" co "), F.col("o_custkey")), F.col("o_orderstatus")), item(F.lit(""), F.lit("9元")))
    return F.when(F.col("o_orderkey") % 3 == 0, two).when(F.col("o_orderkey") % 3 == 1, F.slice(two, 1, 1)).otherwise(F.slice(two, 1, 0))


@query("g13_fan_out_results", """
select o_orderkey, coalesce(i, 0) as item_no, case when i = 0 then 'co ' || o_custkey else o_orderpriority end as company, case when i = 0 then o_orderstatus when i = 1 then '9元' else '' end as money
from (select *, unnest(case o_orderkey % 3 when 0 then [0, 1] when 1 then [0] else [null] end) as i from orders)""")
def g13(t):
    base = t.wide("orders").select("o_orderkey", F.col("o_orderpriority").alias("company"), F.lit("").alias("money"), result_items().alias("items"))
    return fan_out_results(base, "items", {"company": "company", "money": "money"}).withColumn("item_no", F.coalesce("item_no", F.lit(0)))


@query("g13_first_result", """
select o_orderkey, case when o_orderkey % 3 < 2 then 'co ' || o_custkey else o_orderpriority end as company, case when o_orderkey % 3 < 2 then o_orderstatus else '' end as money from orders""")
def g13_first(t):
    base = t.wide("orders").select("o_orderkey", F.col("o_orderpriority").alias("company"), F.lit("").alias("money"), result_items().alias("items"))
    return fan_out_results(base, "items", {"company": "company", "money": "money"}, "first").drop("item_no")


@query("g14_remap_keys", """
select o_orderkey, 'T' || o_orderkey as title, o_orderstatus as number, 'co ' || o_custkey || ':' || '5元' as result from orders""")
def g14(t):
    body = text_of('{"招标名称":" T', F.col("o_orderkey"), '","项目编号":"', F.col("o_orderstatus"), '","结果":[{"中标人":"co ', F.col("o_custkey"), '","金额":"5元"},3]}')
    r = t.wide("orders").select("o_orderkey", jx.remap_keys(jx.parse_payload(body), {"招标名称": "title", "项目编号": "number"}, "结果", {"中标人": "company", "金额": "money"}).alias("r"))
    return r.select("o_orderkey", "r.title", "r.number", F.array_join(F.transform("r.result", lambda x: F.concat_ws(":", x.company, x.money)), ",").alias("result"))


@query("g15_first_or_join", "select p_partkey, case when p_size % 2 = 0 then p_name else p_brand || ' / ' || p_type end as names from part")
def g15(t):
    single = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), F.col("p_name"))).otherwise(" ")
    return t.part.select("p_partkey", jx.first_or_join(single, F.array(F.col("p_brand"), F.lit("　"), F.col("p_type"))).alias("names"))
