"""HTML extraction on the given pages, and on notice pages derived from the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import markup as mk
from harvestry.functions import text as tx
from harvestry.operators import pages as pg
from harvestry.plans.inputs import NOTICE_PAGE
from harvestry.plans.registry import query
from harvestry.plans.text import ENTITIES, squeezed, stripped

ORIGIN = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
LINKS = f"""l as (select page_id, list_filter(list_transform(regexp_extract_all(html, 'href="([^"]+)"', 1), lambda h: case when h in ('/.', '/..') then '/' else h end), lambda h: h <> '') as hs, {ORIGIN} as origin from pages),
d as (select page_id, origin, list_transform(list_filter(generate_series(1, len(hs)), lambda i: list_position(hs, hs[i]) = i), lambda i: hs[i]) as hs from l),
links as (select page_id, unnest(generate_series(0, len(hs) - 1)) as pos, unnest(list_transform(hs, lambda h: origin || h)) as link from d)"""


def notice_pages(t):
    return t.wide("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.concat(F.lit("http://n.example.com/list/"), F.col("o_orderkey")).alias("url"), F.expr(NOTICE_PAGE).alias("html"))


@query("x1_extract_links", f"with {LINKS} select page_id, pos, link from links")
def x1(t):
    return pg.extract_links(t.pages, "page_id", prefix=F.regexp_extract("url", r"^(https?://[^/?#]+)", 1))


@query("x2_route_links", f"""with {LINKS} select page_id, pos, link, case when regexp_matches(path, '^/[A-Z]') then 'list' when regexp_matches(path, 'en$') then 'detail' else 'expert' end as stage
from (select *, regexp_extract(link, '^https?://[^/?#]+([^?#]*)', 1) as path from links) where regexp_matches(path, '^/[A-Z]|en$|^/d')""")
def x2(t):
    return pg.route_links(pg.extract_links(t.pages, "page_id"), {"list": "^/[A-Z]", "detail": "en$", "expert": "^/d"})


@query("x3_extract_attachments", """
select o_orderkey, 0 as pos, 'http://n.example.com/f/' || o_orderkey || '.PDF' as "fileUrl", 'pdf' as "fileType", '文件 ' || o_orderkey as "fileName" from orders
union all select o_orderkey, 1, 'http://n.example.com/download.do?id=' || o_orderkey, 'do', 'download.do' from orders""")
def x3(t):
    return pg.extract_attachments(notice_pages(t), "o_orderkey")


@query("x4_extract_main", "select page_id, regexp_extract(html, '(?s)(<article>.*</article>)', 1) as main from pages")
def x4(t):
    return t.pages.select("page_id", mk.first_block("html", [".txt-content", "#infolist", "article", "body"]).alias("main"))


@query("x4_nested_block", "select o_orderkey, '<h1>标题 ' || o_orderkey as head, '</div>' as tail, true as whole from orders")
def x4_nested(t):
    cut = notice_pages(t).select("o_orderkey", mk.first_block("html", ["#missing", ".wrap", "body"]).alias("b"))
    return cut.select("o_orderkey", F.regexp_extract("b", '^<div class="wrap">(<h1>[^<]*)', 1).alias("head"), F.regexp_extract("b", "(</div>)$", 1).alias("tail"), F.col("b").contains("</script>").alias("whole"))


@query("x5_clean_html", f"""
select page_id, {stripped("regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?i)</?a(?: [^>]*)?>', '', 'g')")} as html from pages""")
def x5(t):
    return t.pages.select("page_id", mk.clean_html("html").alias("html"))


@query("x5_clean_furniture", """
select o_orderkey, '<div>正文' || o_custkey || '<p>发布人：甲 关闭本页</p><span>y</span></div>' as html from orders""")
def x5_furniture(t):
    html = F.concat(F.lit('<script>x()</script><div class="hide" style="display: none">正文'), F.col("o_custkey"),
                    F.lit('<p> 当前位置：首页 </p><a href="/f/download?x=1">附件</a><span><p>相关附件：</p></span><p>发布人：甲 关闭本页</p><a href="/n"><span hidden>y</span></a><input value="我要参与"><!-- 关闭本页 --></div>'))
    cleaned = mk.clean_html(html)
    return t.wide("orders").select("o_orderkey", F.regexp_replace(cleaned, "<span></span>", "").alias("html"))


# Furniture with nested tags, a button of another tag, the popup around its frame, a file known by its text, and hidden content; which of them a page has follows from its keys.
_DIRTY = """'<html><body><div>当前位置：<b>首页</b> &gt; <a href="/i">建设</a></div>' || case o_orderkey % 3 when 0 then '<button value="我要参与"><b>参与</b></button>' when 1 then '<p>当前位置 <i>发布</i>人：甲</p>' else '<span onclick="window.close()"> 关闭本页 </span>' end
  || case o_custkey % 4 when 0 then '<div class="shows hide"><p>澄清<iframe id="cqdyifram"></iframe></p></div>' when 1 then '<a href="/n">PDF版招标文件下载</a>' when 2 then '<div hidden>正文' || cast(o_custkey as string) || '</div>' else '<div>相关附件：<div>表' || cast(o_custkey as string) || '</div></div>' end
  || '<p>正文' || cast(o_orderkey as string) || '<a href="/m">详情</a></p></body></html>'"""


@query("x5_clean_nodes", """
select o_orderkey, '<html><body>' || case o_orderkey % 3 when 1 then '<p>当前位置 <i>发布</i>人：甲</p>' else '' end || case o_custkey % 4 when 2 then '<div>正文' || o_custkey || '</div>' when 3 then '<div>相关附件：<div>表' || o_custkey || '</div></div>' else '' end
  || '<p>正文' || o_orderkey || '详情</p></body></html>' as html from orders""")
def x5_nodes(t):
    return t.wide("orders").select("o_orderkey", mk.clean_html(F.expr(_DIRTY)).alias("html"))


@query("x6_plain_text", f"""
with m as (select page_id, regexp_replace(regexp_extract(html, '(?s)(<article>.*</article>)', 1), '<[^>]+>', chr(10), 'g') as x from pages)
select page_id, array_to_string(list_filter(list_transform(string_split({ENTITIES.format('x')}, chr(10)), lambda y: {squeezed('y')}), lambda y: y <> ''), chr(10)) as body from m""")
def x6(t):
    main = t.pages.select("page_id", mk.first_block("html", ["article", "body"]).alias("main"))
    return main.select("page_id", mk.plain_lines("main").alias("body"))


@query("x7_extract_title", f"select page_id, {squeezed(ENTITIES.format(squeezed('''regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)''')))} as title from pages")
def x7(t):
    return t.pages.select("page_id", mk.extract_title("html").alias("title"))


@query("x7_title_cascade", """
select o_orderkey, case o_orderkey % 4 when 0 then '站 ' || o_custkey when 1 then '标题 ' || o_orderkey when 2 then 'T' || o_orderkey else 'plain' end as title from orders""")
def x7_cascade(t):
    k = F.col("o_orderkey") % 4
    html = (F.when(k == 0, F.concat(F.lit('<h1>no</h1><div class="a title_p"> <span>站</span> '), F.col("o_custkey"), F.lit("</div>"))).when(k == 1, F.expr(NOTICE_PAGE))
            .when(k == 2, F.concat(F.lit("<title>公告 - T"), F.col("o_orderkey"), F.lit("</title>"))).otherwise("<title>plain</title>"))
    return t.wide("orders").select("o_orderkey", mk.extract_title(html).alias("title"))


@query("x7_labelled_title", """
select o_orderkey, case o_orderkey % 5 when 0 then '道路 ' || o_custkey when 1 then '标段' || o_custkey when 2 then '' when 3 then 'T' || o_orderkey else '' end as title from orders""")
def x7_labelled(t):
    k, c = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    item = lambda label, value: F.concat(F.lit(f'<div class="box-item"><span class="item-title">{label}</span><div class="a item-msg">'), value, F.lit("</div></div>"))
    second = item("项目名称", F.lit("later"))
    html = (F.when(k == 0, F.concat(item("项目名称：", F.concat(F.lit(" <b>道路</b> "), c)), second)).when(k == 1, item("<i>标段名称</i> :", F.concat(F.lit("标段"), c)))
            .when(k == 2, F.concat(item("编号", F.lit("9")), second)).when(k == 3, F.concat(F.lit("<title>T"), F.col("o_orderkey"), F.lit("</title>"), second)).otherwise(F.concat(F.lit("<title></title>"), second)))
    return t.wide("orders").select("o_orderkey", mk.extract_title(html).alias("title"))


@query("x8_extract_tables", """
select o_orderkey, 0 as table_no, 0 as row_no, '序号|中标单位|中标金额（元）' as cells from orders union all select o_orderkey, 0, 1, '1|公司 ' || o_custkey || '|' || o_orderstatus from orders
union all select o_orderkey, 0, 2, '乙|9' from orders union all select o_orderkey, 1, 0, '采购人：|甲' || o_custkey || '|联系人|王' from orders union all select o_orderkey, 1, 1, '项目实施主体基本情况|名称|村' || o_custkey from orders
union all select o_orderkey, 1, 2, '联系人|李' || o_orderkey from orders union all select o_orderkey, 1, 3, '流转（需求）标的基本情况|名称|x' from orders""")
def x8(t):
    return pg.extract_tables(notice_pages(t), "o_orderkey").withColumn("cells", F.array_join("cells", "|"))


def grids(t):
    return mk.parse_tables(notice_pages(t).select("o_orderkey", "html"), "html")


def shown(m):
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e.key, e.value)), ";")


@query("x9_pairs_from_rows", "select o_orderkey, '乙=9' as first_table, '联系人=王;采购人=甲' || o_custkey as second_table from orders")
def x9(t):
    pairs = lambda i: shown(mk.pairs_from_rows(mk.clean_rows(F.get("tables", F.lit(i)))))
    return grids(t).select("o_orderkey", pairs(0).alias("first_table"), pairs(1).alias("second_table"))


@query("x10_header_zip", """
select o_orderkey, 'relation_company_name=公司 ' || o_custkey || ';render_money=' || o_orderstatus || ';中标单位=公司 ' || o_custkey || ';中标金额（元）=' || o_orderstatus || ';序号=1' as first_row,
  'relation_company_name=9;中标单位=9;序号=乙' as second_row from orders""")
def x10(t):
    z = grids(t).select("o_orderkey", mk.header_zip(mk.clean_rows(F.get("tables", F.lit(0))), ["中标单位", "成交供应商"]).alias("z"))
    return z.select("o_orderkey", shown(F.get("z", F.lit(0))).alias("first_row"), shown(F.get("z", F.lit(1))).alias("second_row"))


@query("x11_field_map", """
select o_orderkey, 'JN2-' || o_orderkey as last_number, 'JN-' || o_orderkey as first_number, '甲' || o_custkey as unit, '0531-' || o_custkey as phone, '王' as contact from orders""")
def x11(t):
    g = grids(t).select("o_orderkey", "tables", "html", mk.plain_lines("html").alias("lines"))
    s = g.select("o_orderkey", mk.field_sources("html", F.transform("tables", lambda r: mk.clean_rows(r)), "lines").alias("s"))
    m = s.select("o_orderkey", mk.field_map("s").alias("a"), mk.field_map("s", "first").alias("b"))
    return m.select("o_orderkey", F.col("a")["项目编号"].alias("last_number"), F.col("b")["项目编号"].alias("first_number"), F.col("a")["采购人"].alias("unit"),
                    F.col("a")["联系电话"].alias("phone"), F.col("a")["联系人"].alias("contact"))


@query("x12_table_section", "select o_orderkey, '名称=村' || o_custkey || ';联系人=李' || o_orderkey as section from orders")
def x12(t):
    s = mk.table_section(mk.clean_rows(F.get("tables", F.lit(1))), ["项目实施主体", "基本情况"], ["流转（需求）标的基本情况", "流转(需求)标的基本情况"])
    return grids(t).select("o_orderkey", F.array_join(F.transform(s, lambda e: F.concat_ws("=", e.key, e.value)), ";").alias("section"))


@query("x13_list_cards", f"""
with i as (select page_id, {ORIGIN} as origin, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) as items from pages),
c as (select page_id, origin, list_filter(list_transform(items, lambda x: {{'href': regexp_extract(x, 'href="([^"]+)"', 1), 'title': {squeezed("regexp_replace(x, '<[^>]+>', ' ', 'g')")}}}), lambda s: s.href <> '' and s.title <> '') as cs from i),
f as (select page_id, origin, list_transform(list_filter(generate_series(1, len(cs)), lambda k: list_position(list_transform(cs, lambda s: s.href), cs[k].href) = k), lambda k: cs[k]) as cs from c)
select page_id, unnest(generate_series(0, len(cs) - 1)) as pos, unnest(list_transform(cs, lambda s: origin || case when s.href in ('/.', '/..') then '/' else s.href end)) as link, unnest(list_transform(cs, lambda s: s.title)) as title from f""")
def x13(t):
    return pg.list_cards(t.pages, "page_id").select("page_id", "pos", "link", "title")


@query("x13_notice_cards", """
select o_orderkey, 'http://n.example.com/d?pid=' || o_orderkey as link, '公告' || o_custkey as title, '1997-05-28' as date, '历下' as place, '询价' as method, cast(o_orderkey as varchar) as card_id from orders""")
def x13_notices(t):
    html = F.concat(F.lit('<ul><li><a title=" 公告'), F.col("o_custkey"), F.lit('" href="/d?pid='), F.col("o_orderkey"), F.lit('">[历下][询价] x</a><i>1997-05-28</i></li><li><a href="/e"></a></li><li>none</li><li><a href="/d?pid='),
                    F.col("o_orderkey"), F.lit('">again</a></li></ul>'))
    return pg.list_cards(t.wide("orders").select("o_orderkey", F.lit("http://n.example.com/l").alias("url"), html.alias("html")), "o_orderkey").drop("pos")


@query("x14_content_mix", """
select o_orderkey, '公告-T' || o_orderkey as page_title_piece, '序号|中标单位|中标金额（元）' as head, '1|公司 ' || o_custkey || '|' || o_orderstatus || '/' || '|乙|9' as body, true as has_after from orders""")
def x14(t):
    block = notice_pages(t).select("o_orderkey", mk.first_block("html", [".wrap", "body"]).alias("html"))
    parsed = mk.parse_tables(block, "html").withColumn("parts", mk.parse_parts("html"))
    m = parsed.select("o_orderkey", mk.content_mix(F.col("tables"), F.col("parts"), F.concat(F.lit("标题 "), F.col("o_orderkey"))).alias("m"))
    return m.select("o_orderkey", F.concat(F.lit("公告-T"), F.col("o_orderkey")).alias("page_title_piece"), F.array_join("m.head", "|").alias("head"),
                    F.array_join(F.transform("m.body", lambda r: F.array_join(r, "|")), "/").alias("body"), F.col("m.after").contains("联系电话").alias("has_after"))


@query("x14_mix_text", """
select o_orderkey, 'JN-' || o_orderkey || chr(10) || '前言' || o_custkey as before, '联系电话：0531-' || o_custkey || chr(10) || '尾' as after from orders""")
def x14_text(t):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    html = F.concat(F.lit("<div><h1>标题 "), o, F.lit("</h1><div>JN-"), o, F.lit("</div><div><p>前言"), c, F.lit("</p><table><tr><td>a</td></tr></table> 联系电话：0531-"), c, F.lit("</div><table><tr><td>z</td></tr></table><p>尾</p></div>"))
    parsed = mk.parse_tables(t.wide("orders").select("o_orderkey", html.alias("html")), "html").withColumn("parts", mk.parse_parts("html"))
    m = parsed.select("o_orderkey", mk.content_mix(F.col("tables"), F.col("parts"), F.concat(F.lit("标题 "), o)).alias("m"))
    return m.select("o_orderkey", F.col("m.before").alias("before"), F.col("m.after").alias("after"))


@query("x15_embedded_state", """
select o_orderkey, cast(o_orderkey as varchar) as pid, 'A' || o_orderkey as id, 'n/m' as name, 'B' || o_custkey as kind, '' as none, 'e' as early, 'v' || o_custkey as active from orders""")
def x15(t):
    html = F.concat(F.expr(NOTICE_PAGE), F.lit('<ul id="tabs"><a class="x">1</a><a class="tab on" data-id="v'), F.col("o_custkey"), F.lit('">2</a></ul>'))
    h = t.wide("orders").select("o_orderkey", html.alias("html"))
    s = h.select("o_orderkey", "html", mk.script_assignments("html", "x", mk.script_aliases("html")).alias("s"))
    return s.select("o_orderkey", mk.script_var("html", "pid").alias("pid"), *[F.col("s")[k].alias(k) for k in ("id", "name", "kind", "none", "early")], mk.active_attr("html", "tabs", "data-id").alias("active"))


@query("x15_page_script", "select page_id, '</p>' as t, '7' as missing from pages")
def x15_pages(t):
    return t.pages.select("page_id", mk.script_var("html", "t").alias("t"), mk.script_var("html", "nothing", "7").alias("missing"))


@query("x16_pick_image", """
select o_orderkey, case when o_orderkey % 3 = 2 then '' else 'http://n.example.com/img/p-' || o_orderkey || '.jpg' end as image from orders""")
def x16(t):
    k = F.col("o_orderkey") % 3
    name = F.when(k == 0, F.concat(F.lit("P"), F.col("o_custkey"))).otherwise("nobody")
    marker = F.when(k == 1, F.concat(F.lit("/IMG/p-"), F.col("o_orderkey"), F.lit("."))).otherwise("")
    return pg.pick_image(notice_pages(t), "o_orderkey", name, marker, ["logo", "/doctor-0."])


@query("x17_profile_from_page", f"""
select page_id, regexp_extract(url, '/(\\d+)(?:\\.html|/)?(?:[?#]|$)', 1) as profile_id, {squeezed(ENTITIES.format(squeezed('''regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)''')))} as name,
  {squeezed(ENTITIES.format("regexp_extract(html, '&middot;([^<' || chr(13) || chr(10) || ']+)', 1)"))} as footer, {squeezed(ENTITIES.format("regexp_replace(regexp_extract(html, '(?s)<p>(.*?)</p>', 1), '<[^>]+>', '', 'g')"))} as intro from pages""".replace("\\\\", "\\"))
def x17(t):
    from harvestry.operators.records import profile_from_page

    return profile_from_page(t.pages, "page_id", id_pattern=r"/(\d+)(?:\.html|/)?(?:[?#]|$)", labels={"footer": "&middot;"}, intro_pattern=r"(?is)<article>.*?<p>(.*?)</p>")


@query("x18_dataset_assets", "select o_orderkey, 't2-' || o_orderkey as token, 'b' || o_custkey || '.CSV' as filename from orders")
def x18(t):
    a = notice_pages(t).select("o_orderkey", mk.dataset_assets("html").alias("a"))
    return a.select("o_orderkey", F.col("a")["csv"]["token"].alias("token"), F.col("a")["csv"]["filename"].alias("filename"))


@query("x19_leaf_links", """
with l as (select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) as origin, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), 'href="([^"]+)"', 1) as hs from pages),
d as (select page_id, origin, list_transform(list_filter(generate_series(1, len(hs)), lambda i: list_position(hs, hs[i]) = i), lambda i: hs[i]) as hs from l),
e as (select page_id, list_transform(case when len(hs) > 1 then hs[2:] else hs end, lambda h: origin || case when h in ('/.', '/..') then '/' else h end) as hs from d)
select page_id, unnest(generate_series(0, len(hs) - 1)) as pos, unnest(hs) as link from e""")
def x19(t):
    return pg.leaf_links(t.pages, "page_id", r"(?is)<nav>(.*?)</nav>", r'(?i)href="([^"]+)"')


@query("x19_leaf_areas", """
select o_orderkey, lpad(cast(o_custkey as varchar), 6, '0') as area_code from orders where o_custkey % 100 <> 0""")
def x19_areas(t):
    link = F.concat(F.lit("http://e.example.com/list_a"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit(".html?x=1"))
    return pg.leaf_area_links(t.wide("orders").select("o_orderkey", link.alias("link")), r"^/list_a(\d{6})\.html$").select("o_orderkey", "area_code")


@query("x20_discover_tasks", """
with a as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]+)">[^<]*</a>', 1)) as href, unnest(regexp_extract_all(html, '<a href="[^"]+">([^<]*)</a>', 1)) as notice_type from pages)
select a.page_id, a.href, a.notice_type, r_name as module from a join (select '/' || w as href, r_name from region, (values ('the', 0), ('of', 1), ('en', 2), ('la', 3), ('der', 4)) v(w, k) where r_regionkey = k) c using (href) where notice_type <> ''""")
def x20(t):
    word = F.element_at(F.array(*[F.lit(w) for w in ("the", "of", "en", "la", "der")]), F.col("r_regionkey") + 1)
    config = t.region.select(F.concat(F.lit("/"), word).alias("href"), F.col("r_name").alias("module"))
    return pg.discover_tasks(t.pages, "page_id", config).drop("pos")


@query("x20_expand_options", "select o_orderkey, 'k' || o_orderstatus as value, '类' || o_orderstatus as sub_type from orders")
def x20_options(t):
    return pg.expand_options(notice_pages(t), F.col("html"), "kind", ["o_orderkey"])


@query("x21_breadcrumb_and_heading", """
select o_orderkey, '科' || o_custkey as crumb, '简介' || chr(10) || o_orderstatus as intro, '级' || o_orderstatus as title from orders""")
def x21(t):
    items = F.regexp_extract_all("html", F.lit(r'(?is)<div class="i">.*?</div>'), 0)
    return notice_pages(t).select("o_orderkey", mk.breadcrumb_next("html", r'(?is)<nav class="position">(.*?)</nav>', "医生").alias("crumb"),
                                  mk.after_heading("html", "h3", "医生简介").alias("intro"), mk.labelled_items(items)["职称"].alias("title"))
