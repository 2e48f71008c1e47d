"""Projections, filters and predicates on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import text as tx
from harvestry.functions import urls
from harvestry.operators import shaping as sh
from harvestry.plans.registry import query
from harvestry.session import written


@query("p1_project", """
select cast(c_custkey as varchar) as customer_id, trim(c_name) as name, trim(c_mktsegment) as segment, '' as phone from customer""")
def p1(t):
    padded = t.customer.withColumn("c_name", F.concat(F.lit("　"), F.col("c_name"), F.lit("\n")))
    return sh.project(padded, {"customer_id": "c_custkey", "name": "c_name", "segment": "c_mktsegment", "phone": "c_phone"}, ["customer_id"])


@query("p2_first_non_empty", """
select p_partkey, case when p_size % 3 = 0 then p_name when p_size % 3 = 1 then p_type else p_brand end as label from part""")
def p2(t):
    a = F.when(F.col("p_size") % 3 == 0, F.col("p_name"))
    b = F.when(F.col("p_size") % 3 == 1, F.concat(F.lit("  "), F.col("p_type"))).otherwise("　 ")
    return t.part.select("p_partkey", tx.first_non_empty(a, b, "p_brand").alias("label"))


@query("p3_alias_chain", """
select o_orderkey, case when o_orderkey % 2 = 0 then o_orderpriority else o_orderstatus end as title, cast(o_custkey as varchar) as owner from orders""")
def p3(t):
    df = t.orders.withColumn("title_a", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise(""))
    return sh.alias_chain(df, {"title": ["missing_column", "title_a", "o_orderstatus"], "owner": ["owner_id", "o_custkey"]}, ["o_orderkey"])


@query("p4_fill_set_reset", """
select c_custkey, case when c_custkey % 2 = 0 then c_mktsegment else c_name end as filled,
  case when c_custkey % 3 = 0 then c_mktsegment else c_name end as overridden, '' as note from customer""")
def p4(t):
    target = F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_name"))
    value = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).otherwise(" ")
    df = t.customer.select("c_custkey", sh.fill_if_empty(target, F.col("c_mktsegment")).alias("filled"),
                           sh.set_if_present(F.col("c_name"), value).alias("overridden"), F.col("c_name").alias("note"))
    return sh.reset_fields(df, ["note"])


@query("p5_compact", """
select p_partkey, 'brand=' || p_brand || case when p_size % 2 = 0 then ';name=' || p_name else '' end || ';type=' as listed,
  'brand=' || p_brand || case when p_size % 2 = 0 then ';name=' || p_name else '' end as every from part""")
def p5(t):
    m = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("name"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(""), F.lit("type"), F.lit(""))
    show = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e.key, e.value)), ";")
    return t.part.select("p_partkey", show(sh.compact(m, ["name"])).alias("listed"), show(sh.compact(m)).alias("every"))


@query("p6_require_fields", """
select doc_id, case when doc_id % 4 = 0 and doc_id % 6 = 0 then 'lang,source' when doc_id % 4 = 0 then 'lang' else 'source' end as missing
from documents where doc_id % 4 = 0 or doc_id % 6 = 0""")
def p6(t):
    df = t.documents.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "　 ").otherwise(F.col("lang")).alias("lang"),
                            F.when(F.col("doc_id") % 6 != 0, F.col("source")).alias("source"))
    _, rejected = sh.require_fields(df, ["lang", "source"])
    return rejected.select("doc_id", F.array_join("missing", ",").alias("missing"))


@query("p7_keep_or_reject", """
select c_custkey, case when c_custkey % 7 = 0 then 'missing_name' when c_acctbal < 0 then 'negative_balance'
  when c_mktsegment = 'FURNITURE' then 'segment' else '' end as reject_reason from customer""")
def p7(t):
    name = F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_name"))
    rules = [(tx.is_blank(name), "missing_name"), (F.col("c_acctbal") < 0, "negative_balance"), (F.col("c_mktsegment") == "FURNITURE", "segment")]
    return sh.keep_or_reject(t.customer, rules).select("c_custkey", "reject_reason")


@query("p8_is_placeholder_name", """
select p_partkey, p_size % 5 in (0, 1, 2) or p_name like '%ring%' as placeholder from part""")
def p8(t):
    k = F.col("p_size") % 5
    name = F.when(k == 0, "★ ").when(k == 1, F.concat(F.lit(" 00"), F.col("p_partkey"))).when(k == 2, "A").otherwise(F.col("p_name"))
    return t.part.select("p_partkey", sh.is_placeholder_name(name, "ring").alias("placeholder"))


VIABLE_NAME = """case when s_suppkey % 6 = 0 then s_name || '医院' when s_suppkey % 6 = 1 then s_name when s_suppkey % 6 = 2 then '医生圈平台'
  when s_suppkey % 6 = 3 then '★医院★' when s_suppkey % 6 = 4 then 'x✔y医院' else 'HPV人民医院' end"""


@query("p9_is_viable_entity_name", """
select s_suppkey, s_suppkey % 6 in (0, 3, 5) as viable, s_suppkey % 6 in (0, 3, 4) as viable_strict from supplier""")
def p9(t):
    from harvestry.specs import words

    name = F.expr(VIABLE_NAME)
    strict = sh.is_viable_entity_name(name, words.STRICT_ENTITY_KEYWORDS, suspicious=words.SUSPICIOUS_ENTITY_WORDS)
    return t.supplier.select("s_suppkey", sh.is_viable_entity_name(name).alias("viable"), strict.alias("viable_strict"))


@query("p10_all_blank", "select doc_id from documents where doc_id % 2 = 0 and doc_id % 3 = 0")
def p10(t):
    df = t.documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")).alias("a"), F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("b"))
    return df.filter(sh.all_blank(["a", "b"])).select("doc_id")


@query("p11_backfill_candidates", """
select doc_id, source from documents where text <> '' and not regexp_matches(text, 'The|享年') and (doc_id % 5 <> 0)
and (lang = 'en' or source = 'src1')""")
def p11(t):
    df = t.documents.select("doc_id", "text", F.when(F.col("doc_id") % 5 == 0, "N").alias("flag"), F.when(F.col("lang") != "en", F.col("lang")).alias("a"),
                            F.when(F.col("source") == "src1", "void 0").otherwise(F.col("source")).alias("b"), "source")
    return sh.backfill_candidates(df, "text", "The|享年", "flag", "a", "b", columns=["doc_id", "source"])


@query("p12_not_yet_migrated", """
select c_custkey, c_name from customer where c_custkey % 4 <> 1 and c_custkey % 3 <> 0 order by c_custkey""")
def p12(t):
    df = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 4 == 1, "").otherwise(F.col("c_name")).alias("c_name"),
                           F.when(F.col("c_custkey") % 3 == 0, "kept").when(F.col("c_custkey") % 3 == 1, "").alias("origin"))
    return sh.not_yet_migrated(df, "c_name", "origin", ["c_custkey"]).select("c_custkey", "c_name")


@query("p13_on_date", "select o_orderkey from orders where o_orderdate >= date '1997-05-28' and o_orderdate < date '1997-05-29'")
def p13(t):
    return sh.on_date(t.orders, "o_orderdate", "1997-05-28").select("o_orderkey")


@query("p13_on_date_text", """
select o_orderkey from orders where o_orderdate >= date '1997-05-28' and o_orderdate < date '1997-05-29' and o_orderkey % 3 <> 2""")
def p13_text(t):
    k = F.col("o_orderkey") % 3
    text = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format("o_orderdate", " yyyy-M-d "))
            .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd")))
    return sh.on_date(t.orders.select("o_orderkey", text.alias("day")), "day", "1997-05-28").select("o_orderkey")


@query("p14_url_path_filter", r"""
select page_id, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as path from pages
where regexp_matches(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '^/[a-z]{2}/\d+(?:\.html)?$')""")
def p14(t):
    return (t.pages.filter(urls.url_path_matches("url", r"^/[a-z]{2}/\d+(?:\.html)?$"))
            .select("page_id", urls.url_path("url").alias("path")))


@query("p15_allow_list", """
select event_id, user_id % 3 as module, event_type from events where user_id % 3 = 2 or (user_id % 3 = 0 and event_type in ('click', 'purchase'))
  or (user_id % 3 = 1 and event_type = 'signup')""")
def p15(t):
    df = t.events.select("event_id", (F.col("user_id") % 3).alias("module"), "event_type", F.col("user_id").cast("string").alias("code"))
    df = df.filter(F.col("event_type") != "all")
    return sh.allow_list(df, {0: ["click", "purchase"], 1: ["signup"]}, "module", "event_type", "code", "all").drop("code")


@query("p16_threshold_expand", """
with c as (select conv_id, count(*) as turns from conversations group by 1)
select v.conv_id, v.turn as child_turn, v.role as child_role from conversations v join c using (conv_id) where c.turns > 2 and v.role = 'assistant'""")
def p16(t):
    # A conversation's turns stay rows; only counts are aggregated, and written, so a huge conversation never becomes one value and its rows can be split.
    turns = written(t.conversations.groupBy("conv_id").agg(F.count("*").alias("n_turns")), "turns")
    rows = t.conversations.join(turns, "conv_id").select("conv_id", "n_turns", F.array(F.struct(F.col("turn").alias("child_turn"), F.col("role").alias("child_role"))).alias("kids"))
    return sh.threshold_expand(rows, "n_turns", 2, "kids", F.col("child.child_role") == "assistant", ["conv_id"])


@query("p17_classify_response", """
select page_id, case page_id % 6 when 0 then 'ok' when 1 then 'jsl_challenge' when 2 then 'environment_check' when 3 then 'waf_block' when 4 then 'jsl_challenge' else 'unknown' end as kind,
  case when page_id % 6 = 3 then 'E' || page_id end as event_id from pages""")
def p17(t):
    k = F.col("page_id") % 6
    status = F.when(k.isin(0, 3, 4), 200).when(k == 1, 521).when(k == 2, 412).otherwise(503)
    extra = (F.when(k == 1, "document.cookie; location.href").when(k == 2, "Environment CHECKING")
             .when(k == 3, F.concat(F.lit('<span id="wafId"> E'), F.col("page_id"), F.lit("</span>"))).when(k == 4, "__jsl_clearance_s location.href").otherwise(""))
    body = F.concat(F.col("html"), extra)
    return t.pages.select("page_id", sh.classify_response(status, body).alias("kind"), sh.block_event_id(body).alias("event_id"))


@query("p17_classify_probe", """
select page_id, case page_id % 8 when 0 then 'ok' when 1 then 'captcha' when 2 then '521_js' when 3 then '521_js' when 4 then '403_block' when 5 then 'other' when 6 then '521_js' else 'captcha' end as kind from pages""")
def p17_probe(t):
    k = F.col("page_id") % 8
    status = F.when(k.isin(4, 5), 403).when(k == 3, 521).when(k == 7, 521).otherwise(200)
    extra = (F.when(k == 1, "本站开启了验证码保护").when(k == 2, "document.cookie='a'").when(k == 4, '<div class="online-desc-con">').when(k == 6, "__jsl_clearance_s")
             .when(k == 7, "document.cookie 本站开启了验证码保护").otherwise(""))
    return t.pages.select("page_id", sh.classify_probe(status, F.concat("html", extra)).alias("kind"))


@query("p18_is_noise_text", """
select doc_id, doc_id % 7 in (0, 1, 2, 5, 6) as noise from documents""")
def p18(t):
    k = F.col("doc_id") % 7
    line = (F.when(k == 0, F.concat(F.lit("当前位置：首页 > "), F.col("text"))).when(k == 1, " 关闭本页 ").when(k == 2, F.concat(F.lit("CA办理及相关咨询请点击"), F.col("source")))
            .when(k == 3, "当前位置 发布人：甲").when(k == 5, F.concat(F.lit("see x.example.com/helpca/index.jsp#nav-7 "), F.col("lang")))
            .when(k == 6, "HTTP://x/new_flogin/login.do?a").otherwise(F.col("text")))
    return t.documents.select("doc_id", sh.is_noise_text(line).alias("noise"))


@query("p19_is_blank_detail", """
select doc_id, doc_id % 2 = 0 and doc_id % 5 in (0, 1) as blank from documents""")
def p19(t):
    k = F.col("doc_id") % 5
    text = (F.when(k == 0, "公告详情\n标题甲\n发布日期：2024-01-01\n关闭本页").when(k == 1, "").when(k == 2, "公告详情").when(k == 3, "首页").otherwise(F.col("text")))
    labels = F.when(k == 2, F.array(F.lit("发布日期"), F.lit("价格"))).otherwise(F.array(F.lit("发布日期")))
    rows = F.when(k == 3, 1).otherwise(0)
    module = F.when(F.col("doc_id") % 2 == 0, "土地矿产").otherwise("政府采购")
    blank = sh.is_blank_detail(module, F.lit("招标公告"), F.lit("标题甲"), labels, rows, text)
    return t.documents.select("doc_id", blank.alias("blank"))


@query("p20_is_shell_page", "select page_id from pages where html like '%</nav>%' and not (html like '%&quot;%' or html like '%***%')")
def p20(t):
    return t.pages.filter(sh.is_shell_page(F.col("html"), "</nav>", ["&quot;", "***"])).select("page_id")
