"""Record builders and whole jobs on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from harvestry.functions import markup as mk
from harvestry.functions.text import any_contains, classify_board, let, strip_edge_noise
from harvestry.operators import flagships as fl
from harvestry.operators import pages as pg
from harvestry.operators import records as rc
from harvestry.plans.inputs import NOTICE_PAGE, _fill
from harvestry.plans.pages import ORIGIN
from harvestry.plans.registry import query
from harvestry.plans.text import ENTITIES, squeezed

SITE = rc.Site("990000", "测试省", "990100", "测试市", "测试平台")
MODULE = "case o_custkey % 3 when 0 then '政府采购' when 1 then '工程建设' else '国企采购' end"
NOTICE_TYPE = "case o_orderkey % 5 when 0 then '采购需求(意向)' when 1 then '中标候选人公示' when 2 then '中标结果公示' when 3 then '合同及履约' else '采购公告' end"
TRADE_TYPE = "case o_orderkey % 2 when 0 then '施工' else o_orderpriority end"
BOARD = f"""case when o_orderkey % 5 = 0 and o_custkey % 3 = 0 then '采购意向' when o_orderkey % 5 = 1 then '候选人公告' when o_orderkey % 5 in (2, 3) then '中标公告' else '招标公告' end"""
GATED = f"case when o_custkey % 3 = 1 and o_orderkey % 2 = 1 then '' else {TRADE_TYPE} end"


def context(t):
    pages = t.wide("orders").select("o_orderkey", F.concat(F.lit("http://n.example.com/list/"), F.col("o_orderkey")).alias("url"), F.expr(NOTICE_PAGE).alias("html"), F.lit("list title").alias("title"),
                            F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_time"), F.lit("L1").alias("project_no"), F.expr(MODULE).alias("module"), F.expr(NOTICE_TYPE).alias("notice_type"), F.expr(TRADE_TYPE).alias("trade_type"))
    return rc.common_context(pages, [".wrap", "body"])


COMMON = f"""'标题 ' || o_orderkey as title, 'JN2-' || o_orderkey as project_no, '甲' || o_custkey as unit, '公司 ' || o_custkey as company, o_orderstatus as money, '王' as contact_name, '0531-' || o_custkey as contact_phone"""


@query("b1_common_context", f"select o_orderkey, {COMMON}, {BOARD} as board, 2 as n_files from orders")
def b1(t):
    return context(t).select("o_orderkey", "title", "project_no", "unit", "company", "money", "contact_name", "contact_phone", "board", F.size("files").alias("n_files"))


@query("b2_build_bid", f"""
select o_orderkey, '990000' as "provinceCode", {GATED} as "bidType", '标题 ' || o_orderkey as "announcementTitle", 'JN2-' || o_orderkey as "projectNum", '甲' || o_custkey as "releaseSource", strftime(o_orderdate, '%Y-%m-%d') as "releaseTime",
  1 as "contentType", '名称：甲' || o_custkey || '|项目联系人：王|电话：0531-' || o_custkey as consult, {MODULE} as "parentType" from orders where {BOARD} = '招标公告'""")
def b2(t):
    r = rc.build_bid(context(t).filter("board = '招标公告'"), SITE, ["o_orderkey"])
    consult = F.array_join(F.concat("consultationInfo.purchasing", "consultationInfo.project"), "|")
    return r.select("o_orderkey", "provinceCode", "bidType", "announcementTitle", "projectNum", "releaseSource", "releaseTime", "contentType", consult.alias("consult"), "parentType")


@query("b3_build_win", f"""
select o_orderkey, '标题 ' || o_orderkey as "tenderTitle", 'JN2-' || o_orderkey as "tenderNumber", o_orderstatus as "renderMoney", case when o_custkey % 3 = 1 then {GATED} else '' end as "renderType", '公司 ' || o_custkey as "relationCompanyName",
  case when o_orderkey % 5 = 3 then 1 else 2 end as "announcementType", 0 as "isUnion", 'http://n.example.com/f/' || o_orderkey || '.PDF' as first_file, '990100' as "cityId" from orders where {BOARD} = '中标公告'""")
def b3(t):
    r = rc.build_win(context(t).filter("board = '中标公告'"), SITE, ["o_orderkey"])
    return r.select("o_orderkey", "tenderTitle", "tenderNumber", "renderMoney", "renderType", "relationCompanyName", "announcementType", "isUnion", F.get("uploadFileUrl", F.lit(0)).alias("first_file"), "cityId")


@query("b3_build_win_rows", f"""
select o_orderkey, '标题 ' || o_orderkey as "tenderTitle", 'JN2-' || o_orderkey as "tenderNumber", case n when 1 then o_orderstatus else '' end as "renderMoney", case n when 1 then '公司 ' || o_custkey else '9' end as "relationCompanyName",
  case when o_orderkey % 5 = 3 then 1 else 2 end as "announcementType", 0 as "isUnion", '甲' || o_custkey as "procurementUnit" from orders, (values (1), (2)) as v(n) where {BOARD} = '中标公告'""")
def b3_rows(t):
    r = rc.build_win(context(t).filter("board = '中标公告'"), SITE, ["o_orderkey"], rows="all")
    return r.select("o_orderkey", "tenderTitle", "tenderNumber", "renderMoney", "relationCompanyName", "announcementType", "isUnion", "procurementUnit")


@query("b4_build_candidate", f"""
select o_orderkey, '标题 ' || o_orderkey as "tenderTitle", '公司 ' || o_custkey as "relationCompanyName", '第一候选人：公司 ' || o_custkey || '|第二候选人：9' as ranks, 'JN2-' || o_orderkey as number, '中标候选人' as "renderType" from orders where {BOARD} = '候选人公告'""")
def b4(t):
    r = rc.build_candidate(context(t).filter("board = '候选人公告'"), SITE, ["o_orderkey"])
    return r.select("o_orderkey", "tenderTitle", "relationCompanyName", F.array_join("extra.candidateSort", "|").alias("ranks"), F.col("extra.tenderNumber").alias("number"), "renderType")


@query("b5_build_intention", f"""
select o_orderkey, '标题 ' || o_orderkey as "procurementTitle", '序号|中标单位|中标金额（元）' as head, 2 as n_body, strftime(o_orderdate, '%Y-%m-%d') as "releaseDatetime", {NOTICE_TYPE} as "bidType" from orders where {BOARD} = '采购意向'""")
def b5(t):
    r = rc.build_intention(context(t).filter("board = '采购意向'"), SITE, ["o_orderkey"])
    return r.select("o_orderkey", "procurementTitle", F.array_join("releaseContentMix.head", "|").alias("head"), F.size("releaseContentMix.body").alias("n_body"), "releaseDatetime", "bidType")


@query("b6_build_standard", f"select o_orderkey, {BOARD} as board, {MODULE} as module, 'http://n.example.com/list/' || o_orderkey as url from orders")
def b6(t):
    boards = rc.build_standard(rc.routed(context(t).drop("html")), SITE, ["o_orderkey", "board"])
    parts = [df.select("o_orderkey", "board", F.col("parentType").alias("module"), F.col("originalWebsiteAddress").alias("url")) for df in boards.values()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("b7_apply_enrichment", """
select doc_id, case when toxic = 0 and quality = 1 then 'Q' || doc_id when toxic = 0 then '' else lang end as lang, case when toxic = 0 and quality = 1 then 'rule' else source end as source
from documents left join labels using (doc_id)""")
def b7(t):
    good = F.col("quality") == 1
    results = t.labels.select("doc_id", (F.col("toxic") == 0).alias("ok"), F.when(good, F.concat(F.lit(" Q"), F.col("doc_id"))).otherwise(" ").alias("lang"), F.when(good, "rule").alias("source"))
    return rc.apply_enrichment(t.documents.select("doc_id", "lang", "source"), results, "doc_id", ["lang", "source"], "ok", ["lang"])


DAY = "1999-10-28"


def registrations(t, status: str):
    """One raw dataset: text columns in the source's layout, dates in several spellings."""
    day = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-M-d")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", " yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.filter(F.col("o_orderstatus") == status).select(
        F.concat(F.lit(" 企业"), F.col("o_custkey")).alias("企业名称"), F.concat(F.lit("C"), F.col("o_custkey")).alias("统一社会信用代码"), day.alias("成立日期"),
        F.format_string("%.2f", F.col("o_totalprice")).alias("注册资本（万）"), F.col("o_orderpriority").alias("业务类型"), F.col("o_orderkey").alias("row"))


@query("b8_daily_new", f"""
with d as (select o_orderkey, o_custkey, o_totalprice, o_orderpriority, case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as ds from orders where o_orderdate >= date '{DAY}' and o_orderdate < date '{DAY}' + 1),
r as (select *, row_number() over (partition by o_custkey order by ds, o_orderkey) as rn from d)
select '企业' || o_custkey as company_name, 'C' || o_custkey as credit_code, '{DAY}' as establish_date, printf('%.2f', o_totalprice) as registered_capital_10k_cny, '' as legal_representative, o_orderpriority as business_type,
  ['finished', 'open', 'partial'][ds + 1] as source_dataset, 'cat-' || ds as source_catalog_id from r where rn = 1""")
def b8(t):
    datasets = {"finished": (registrations(t, "F"), "cat-0"), "open": (registrations(t, "O"), "cat-1"), "partial": (registrations(t, "P"), "cat-2")}
    layout = {"company_name": "企业名称", "credit_code": "统一社会信用代码", "establish_date": "成立日期", "registered_capital_10k_cny": "注册资本（万）", "legal_representative": "法定代表人", "business_type": "业务类型"}
    return fl.daily_new(datasets, layout, "credit_code", ["establish_date"], "establish_date", DAY, "row")


def named_supplier(name):
    return let(strip_edge_noise(name), lambda x: (F.length(x) >= 2) & any_contains(x, ["医院", "Supplier"]))


BACKFILL_TWIN = """
with k as (select 'Supplier#' || lpad(cast(s_suppkey as varchar), 9, '0') as query_name from supplier where s_acctbal < 2000),
q as (select distinct case when o_custkey % 4 = 3 then '第' || (o_custkey % 50) || '医院' else 'Supplier#' || lpad(cast(o_custkey % 200 as varchar), 9, '0') end as query_name from orders where o_custkey % 4 <> 0),
todo as (select query_name, replace(query_name, '#', '') as key from q where query_name not in (select query_name from k)),
ref as (select s_suppkey, s_nationkey, case when s_suppkey % 3 = 0 then '市第' || s_suppkey || '医院' else s_name end as ref_name from supplier),
ex as (select key, min(s_suppkey) as s from todo join ref on replace(ref_name, '#', '') = key group by 1),
sf as (select key, count(*) as n, min(s_suppkey) as s from todo join ref on replace(ref_name, '#', '') <> key and ends_with(replace(ref_name, '#', ''), key) group by 1),
f as (select t.query_name, coalesce(ex.s, case when sf.n = 1 then sf.s end) as s from todo t left join ex using (key) left join sf using (key)),
e as (select case when f.s is not null then cast(f.s as varchar) else query_name end as entity_key, query_name, coalesce(r.ref_name, query_name) as entity_name, case when f.s is not null then 'Y' else 'N' end as resolved, coalesce(cast(r.s_nationkey as varchar), '') as s_nationkey from f left join ref r on r.s_suppkey = f.s),
last as (select * from e qualify row_number() over (partition by entity_key order by query_name desc) = 1),
base as (select 'known' || s_suppkey as entity_key, s_name as query_name, s_name as entity_name, 'Y' as resolved, cast(s_nationkey as varchar) as s_nationkey from supplier where s_acctbal < 2000),
out as (select * from last union all select * from base where entity_key not in (select entity_key from last))"""


def backfilled(t):
    c = F.col("o_custkey")
    asked = F.when(c % 4 == 0, "★ 12").when(c % 4 == 3, F.concat(F.lit("、第"), c % 50, F.lit("医院☆"))).otherwise(F.concat(F.lit("Supplier#"), F.lpad((c % 200).cast("string"), 9, "0"), F.lit("。")))
    known = t.supplier.filter("s_acctbal < 2000").select(F.concat(F.lit("known"), F.col("s_suppkey")).alias("entity_key"), F.col("s_name").alias("query_name"), F.col("s_name").alias("entity_name"), F.lit("Y").alias("resolved"), F.col("s_nationkey").cast("string").alias("s_nationkey"))
    ref = t.supplier.select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("市第"), F.col("s_suppkey"), F.lit("医院"))).otherwise(F.col("s_name")).alias("ref_name"))
    return fl.entity_backfill(t.orders.select(asked.alias("name")), "name", known, ref, "ref_name", "s_suppkey", ["s_nationkey"], named_supplier)


@query("b9_entity_backfill", BACKFILL_TWIN + " select * from out")
def b9(t):
    return backfilled(t)


@query("b9_backfill_counts", BACKFILL_TWIN + " select resolved, count(*) as n from out group by 1")
def b9_counts(t):
    return fl.backfill_counts(backfilled(t))


# Five shapes of detail page: one result row; labelled text without tables; several winners; no main block and unclosed tags; nothing but a title and a date.
SHAPES = [
    "'<div class=\"wrap\"><h1>标题 {o}</h1><p>项目编号：JN-{o}</p><table><tr><th>序号</th><th>中标单位</th><th>中标金额（元）</th></tr><tr><td>1</td><td>公司<b>{c}</b></td><td>{c}</td></tr></table><table><tr><td>采购人：</td><td>甲{c}</td><td>联系人</td><td>王{c}</td></tr></table><a href=\"/f/{o}.PDF\">文件 {o}</a></div>'",
    "'<div class=\"wrap\"><h1>标题 {o}</h1><p>项目编号：TX-{o}</p><p>采购单位：乙{c}</p><p>预算金额：{c}元</p><p>采购方式：公开招标</p><p>联系电话：0531-{c}</p></div>'",
    "'<div class=\"wrap\"><h2>标题 {o}</h2><table><tr><td>招标人</td><td>丙{c}</td></tr></table><table><tr><th>中标单位</th><th>中标金额（元）</th></tr><tr><td>甲{c}公司、乙{c}公司</td><td>{o}</td></tr><tr><td>丁{c}</td><td>7</td></tr></table><a href=\"/f/{o}.doc\">附件</a><a href=\"/f/{o}.doc\">again</a><a href=\"/g/{c}.pdf\">二</a></div>'",
    "'<p>开头{c}<p>项目编号：BD-{o}<p>中标单位：戊{c}<p>中标金额：{c}.50元'",
    "'<div class=\"wrap\"><h1>标题 {o}</h1><p>发布日期：2020-01-01</p></div>'",
]
SHAPE = "case cast(floor(o_custkey / 4) as int) % 5 " + " ".join(f"when {k} then {_fill(s)}" for k, s in enumerate(SHAPES)) + " end"
TASK_MODULE = "case o_custkey % 4 when 0 then '政府采购' when 1 then '工程建设' when 2 then '国企采购' else '土地矿产' end"
TASK_TYPE = "case o_orderkey % 5 when 0 then '采购需求(意向)' when 1 then '中标候选人公示' when 2 then '结果公示' when 3 then '合同及履约' else '招标公告' end"


def noticed(t, win_rows="first"):
    """Cards of all orders met with their pages: one page in seven has not landed, one in eleven was captured twice."""
    url = F.concat(F.lit("http://n.example.com/list/"), F.col("o_orderkey"))
    cards = t.orders.select("o_orderkey", url.alias("url"), F.concat(F.lit("列表 "), F.col("o_orderkey")).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_time"),
                            F.lit("L1").alias("project_no"), F.expr(TASK_MODULE).alias("module"), F.expr(TASK_TYPE).alias("notice_type"), F.expr(TRADE_TYPE).alias("trade_type"))
    landed = t.wide("orders").filter("o_orderkey % 7 <> 3")
    pages = landed.select(url.alias("url"), F.concat(F.lit("<html><body>"), F.expr(SHAPE), F.lit("</body></html>")).alias("html"))
    again = landed.filter("o_orderkey % 11 = 0").select(url.alias("url"), F.lit("<html>cut").alias("html"))
    ok = t.orders.filter("o_orderkey % 13 = 0").select("o_orderkey", F.lit(True).alias("ok"), F.concat(F.lit(" 模型 "), F.col("o_orderkey")).alias("tenderTitle"), F.lit("").alias("procurementUnit"))
    extra = {"中标公告": fl.Enrichment(ok, ["tenderTitle", "procurementUnit"], "ok", ["procurementUnit"])}
    return fl.notices(cards, pages.unionByName(again), [".wrap", "body"], SITE, "o_orderkey", extra, win_rows)


def board_columns(boards):
    """One table of the four boards; what a board has not is ''."""
    text = lambda name, **own: F.coalesce(own[name].cast("string"), F.lit("")).alias(name) if name in own else F.lit("").alias(name)
    names = ("title", "number", "unit", "company", "money", "kind", "code", "is_union", "method", "budget", "date", "ranks", "mix", "contact", "files")
    own = {
        "招标公告": {"title": F.col("announcementTitle"), "number": F.col("projectNum"), "unit": F.col("releaseSource"), "kind": F.col("bidType"), "code": F.col("announcementType"), "method": F.col("procurementMethod"),
                 "budget": F.col("budgetAmount"), "date": F.col("releaseTime"), "contact": F.array_join(F.concat("consultationInfo.purchasing", "consultationInfo.project"), "|"), "files": F.size("fileInfo")},
        "中标公告": {"title": F.col("tenderTitle"), "number": F.col("tenderNumber"), "unit": F.col("procurementUnit"), "company": F.col("relationCompanyName"), "money": F.col("renderMoney"), "kind": F.col("renderType"),
                 "code": F.col("announcementType"), "is_union": F.col("isUnion"), "date": F.col("renderDate"), "contact": F.concat_ws("|", "contactName", "contactTelephone"), "files": F.size("uploadFileUrl")},
        "候选人公告": {"title": F.col("tenderTitle"), "number": F.col("extra.tenderNumber"), "unit": F.col("procurementUnit"), "company": F.col("relationCompanyName"), "kind": F.col("renderType"),
                  "ranks": F.array_join("extra.candidateSort", "|"), "date": F.col("renderDate"), "files": F.size("uploadFileUrl")},
        "采购意向": {"title": F.col("procurementTitle"), "unit": F.col("releaseSource"), "kind": F.col("bidType"), "date": F.col("releaseDatetime"),
                 "mix": F.concat_ws("/", F.array_join("releaseContentMix.head", "|"), F.size("releaseContentMix.body").cast("string")), "files": F.size("fileInfo")},
    }
    parts = [df.select("o_orderkey", F.lit(board).alias("board"), *[text(n, **own[board]) for n in names]) for board, df in boards.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


NOTICES_TWIN = f"""
with p as (select *, cast(floor(o_custkey / 4) as int) % 5 as s, {TASK_MODULE} as module, {TASK_TYPE} as type, {TRADE_TYPE} as trade from orders where o_orderkey % 7 <> 3),
b as (select *, cast(o_orderkey as varchar) as k, cast(o_custkey as varchar) as c, strftime(o_orderdate, '%Y-%m-%d') as day, case when module = '工程建设' and o_orderkey % 2 = 1 then '' else trade end as gate,
  case when o_orderkey % 5 = 0 and module = '政府采购' then '采购意向' when o_orderkey % 5 = 1 then '候选人公告' when o_orderkey % 5 in (2, 3) then '中标公告' else '招标公告' end as board
  from p where not (s = 4 and module = '土地矿产' and type in ('招标公告', '结果公示'))),
f as (select *, case when s = 3 then '列表 ' else '标题 ' end || k as heading, case s when 0 then 'JN-' || k when 1 then 'TX-' || k when 3 then 'BD-' || k else 'L1' end as number_,
  case s when 0 then '甲' || c when 1 then '乙' || c when 2 then '丙' || c else '' end as unit_, case s when 0 then '公司 ' || c when 2 then '甲' || c || '公司、乙' || c || '公司' when 3 then '戊' || c else '' end as company_ from b)
select o_orderkey, board, case when board = '中标公告' and o_orderkey % 13 = 0 then '模型 ' || k else heading end as title, case when board = '采购意向' then '' else number_ end as number,
  case when board = '采购意向' then trim(regexp_extract(heading, '^(.*?)20[0-9][0-9]', 1)) when board = '中标公告' and o_orderkey % 13 = 0 then '' else unit_ end as unit, case when board in ('中标公告', '候选人公告') then company_ else '' end as company,
  case when board <> '中标公告' then '' when s = 0 then c || '元' when s = 2 then k || '元' when s = 3 then c || '.50元' else '' end as money,
  case board when '招标公告' then gate when '中标公告' then case when module = '工程建设' then gate else '' end when '候选人公告' then '中标候选人' else type end as kind,
  case board when '招标公告' then type when '中标公告' then case when o_orderkey % 5 = 3 then '1' else '2' end else '' end as code, case when board = '中标公告' then '0' else '' end as is_union,
  case when board = '招标公告' and s = 1 then '公开招标' else '' end as method, case when board <> '招标公告' then '' when s = 1 then c || '元' when s = 3 then c || '.50元' else '' end as budget, day as date,
  case when board <> '候选人公告' then '' when s = 0 then '第一候选人：公司 ' || c when s = 2 then '第一候选人：' || company_ || '|第二候选人：丁' || c else '' end as ranks,
  case when board <> '采购意向' then '' when s = 0 then '序号|中标单位|中标金额（元）/1' when s = 2 then '招标人|丙' || c || '/0' else '0' end as mix,
  case board when '招标公告' then case s when 0 then '名称：甲' || c || '|项目联系人：王' || c when 1 then '名称：乙' || c || '|电话：0531-' || c when 2 then '名称：丙' || c else '' end
    when '中标公告' then case s when 0 then '王' || c || '|' when 1 then '|0531-' || c else '|' end else '' end as contact, case s when 0 then '1' when 2 then '2' else '0' end as files from f"""


@query("b10_notices", NOTICES_TWIN)
def b10(t):
    return board_columns(noticed(t))
