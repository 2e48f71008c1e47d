"""Text functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import text as tx
from harvestry.plans.inputs import NOTICE
from harvestry.plans.registry import query
from harvestry.specs import words

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def squeezed(sql: str) -> str:
    """Twin of ``collapse``."""
    return f"regexp_replace(regexp_replace({sql}, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def stripped(sql: str) -> str:
    return f"regexp_replace({sql}, '^{WS}+|{WS}+$', '', 'g')"


@query("h1_norm_text", f"""
select doc_id, {squeezed("'　' || replace(text, ' ', chr(160) || ' ') || ' <&> '")} as plain, case when doc_id % 2 = 0 then '' else {squeezed('text')} end as no_null_word from documents""")
def h1(t):
    dirty = F.concat(F.lit("　"), F.regexp_replace("text", " ", "  "), F.lit("&nbsp;&lt;&amp;&gt; "))
    word = F.when(F.col("doc_id") % 2 == 0, " None ").otherwise(F.col("text"))
    return t.documents.select("doc_id", tx.norm_text(dirty).alias("plain"), tx.norm_text(word, null_words=True).alias("no_null_word"))


@query("h2_norm_multiline", f"""
with d as (select doc_id, replace(text, '. ', '.  ' || chr(13) || chr(10) || chr(9) || chr(10) || chr(10)) as x from documents)
select doc_id, {stripped(f"regexp_replace(regexp_replace(regexp_replace(x, chr(13) || '{chr(92)}n?', chr(10), 'g'), '[ {chr(92)}t]+', ' ', 'g'), '{chr(92)}n{WS}*{chr(92)}n+', chr(10) || chr(10), 'g')")} as body from d""")
def h2(t):
    spread = F.replace("text", F.lit(". "), F.lit(".  \r\n\t\n\n"))
    return t.documents.select("doc_id", tx.norm_multiline(spread).alias("body"))


@query("h2_html_multiline", f"""
with d as (select doc_id, array_to_string(list_transform(string_split(text, '. '), lambda x: {stripped('x')}), chr(10)) as x from documents)
select doc_id, {stripped(f"regexp_replace(array_to_string(list_transform(string_split(x, chr(10)), lambda y: {stripped('y')}), chr(10)), '{chr(92)}n{{{{3,}}}}', chr(10) || chr(10), 'g')".replace('{{','{').replace('}}','}'))} as body from d""")
def h2_html(t):
    markup = F.concat(F.lit("<p>"), F.replace("text", F.lit(". "), F.lit("</p> <p class='x'>")), F.lit("</p>"))
    return t.documents.select("doc_id", tx.html_multiline(markup).alias("body"))


@query("h2_join_lines", f"""
select doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {squeezed('x')}), lambda x: x <> ''), chr(10)) as body from documents""")
def h2_lines(t):
    return t.documents.select("doc_id", tx.join_lines(F.replace("text", F.lit("\n"), F.lit(" \n\n\t"))).alias("body"))


ENTITIES = "replace(replace(replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&am<', '&am<'), '&nbsp;', chr(160)), '&amp;', '&')"


@query("h3_strip_tags", f"""
select page_id, {squeezed(ENTITIES.format("regexp_replace(html, '<[^>]+>', ' ', 'g')"))} as spaced, {squeezed(ENTITIES.format("regexp_replace(html, '<[^>]+>', '', 'g')"))} as joined from pages""")
def h3(t):
    return t.pages.select("page_id", tx.strip_tags("html", " ").alias("spaced"), tx.strip_tags("html", "").alias("joined"))


@query("h4_unescape_html", f"select page_id, {ENTITIES.format('html')} as html from pages")
def h4(t):
    return t.pages.select("page_id", tx.unescape_html("html").alias("html"))


@query("h5_strip_edge_noise", "select p_partkey, p_name || ' (' || p_type || ')' as name from part")
def h5(t):
    dirty = F.concat(F.lit("★ 、'-_ ✔"), F.col("p_name"), F.lit(" 　 ("), F.col("p_type"), F.lit(")。 ☆!？ "))
    return t.part.select("p_partkey", tx.strip_edge_noise(dirty).alias("name"))


@query("h6_match_key", "select s_suppkey, regexp_replace('医院' || s_name || '分院', '[^0-9A-Za-z\\x{4e00}-\\x{9fff}]+', '', 'g') as key from supplier".replace("\\\\", "\\"))
def h6(t):
    return t.supplier.select("s_suppkey", tx.match_key(F.concat(F.lit("★医院（"), F.col("s_name"), F.lit("）·分院。"))).alias("key"))


@query("h7_remove_chars", f"""select doc_id, regexp_replace({squeezed('text')}, '[丨｜∣·•／（）()【】\\[\\]「」『』“”"'']', '', 'g') as body from documents""".replace("\\\\", "\\"))
def h7(t):
    return t.documents.select("doc_id", tx.remove_chars("text").alias("body"))


@query("h8_drop_lines", f"""
select doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {stripped('x')}), lambda x: x <> '' and x not in ('The.', 'Of.', 'De.')), chr(10)) as body from documents""")
def h8(t):
    return t.documents.select("doc_id", tx.drop_lines("text", ["The.", "Of.", "De."]).alias("body"))


@query("h9_labeled_value", f"""
select page_id, {squeezed(ENTITIES.format("regexp_extract(html, '(?i)<article>(?:' || '" + WS + "' || '|&nbsp;|<[^>]+>)*([^<' || chr(13) || chr(10) || ']+)', 1)"))} as headline from pages""")
def h9(t):
    return t.pages.select("page_id", tx.labeled_value("html", "<ARTICLE>").alias("headline"))


@query("h10_first_pattern", f"""
select doc_id, case when {squeezed("regexp_extract(text, '(?s)zz(.+?)zz', 1)")} <> '' then {squeezed("regexp_extract(text, '(?s)zz(.+?)zz', 1)")}
 when {squeezed("regexp_extract(text, '(?s)The (.*?)[.]', 1)")} <> '' then {squeezed("regexp_extract(text, '(?s)The (.*?)[.]', 1)")} else {squeezed("regexp_extract(text, '(?s)^(.*?)[.]', 1)")} end as hit from documents""")
def h10(t):
    return t.documents.select("doc_id", tx.first_pattern("text", ["zz(.+?)zz", "The (.*?)[.]", "^(.*?)[.]"]).alias("hit"))


@query("h11_section_value", f"""
with n as (select o_orderkey, {NOTICE} as x from orders),
s as (select o_orderkey, substr(x, strpos(x, '采购人信息') + 5, strpos(x, chr(10) || '2、') - strpos(x, '采购人信息') - 5) as s1, substr(x, strpos(x, '项目联系方式') + 6) as s3 from n)
select o_orderkey, regexp_extract(s1, '名 称：([^\\n]+)', 1) as unit, regexp_extract(s3, '项目联系人：([^\\n]+)', 1) as contact, regexp_extract(s3, '电 话：([0-9]+)', 1) as phone from s""".replace("\\\\", "\\"))
def h11(t):
    x = t.wide("orders").select("o_orderkey", F.expr(NOTICE).alias("x"))
    return x.select("o_orderkey", tx.section_value("x", "采购人信息", r"名\s*称", "[23]", "1").alias("unit"),
                    tx.section_value("x", "项目联系方式", r"(?:项\s*目\s*联\s*系\s*人|联\s*系\s*人)", "[45]", "3", r"([^\n，,；; ]+)").alias("contact"),
                    tx.section_value("x", "项目联系方式", words.PHONE_LABELS, "[45]", "3", words.PHONE_CHARS).alias("phone"))


@query("h12_labelled_fields", """
select o_orderkey, case o_orderkey % 4 when 0 then 'JN-' || o_orderkey when 1 then 'A' || o_custkey when 2 then 'SDGP' || (100000 + o_orderkey) else '' end as project_no,
  case o_orderkey % 3 when 0 then '甲公司' || o_custkey when 1 then '乙局' || o_custkey else '' end as party,
  case when o_orderkey % 5 = 0 then '0531-' || o_custkey else '1390000' || (1000 + o_custkey % 9000) end as phone,
  case when o_orderkey % 5 = 0 and o_orderkey % 3 <> 0 then '赵一' when o_orderkey % 3 = 0 then '王' else '孙' || o_orderkey end as contact from orders""")
def h12(t):
    x = t.wide("orders").select("o_orderkey", F.expr(NOTICE).alias("x"))
    return x.select("o_orderkey", tx.extract_project_no("x").alias("project_no"), tx.extract_party("x").alias("party"), tx.extract_phone("x").alias("phone"), tx.extract_contact("x").alias("contact"))


@query("h13_split_contact", """
select c_custkey, case when c_custkey % 3 < 2 then c_name else '' end as name, case c_custkey % 3 when 0 then '138' || lpad(cast(c_custkey as varchar), 8, '0') when 1 then '0531-' || c_custkey else '' end as phone from customer""")
def h13(t):
    k = F.col("c_custkey")
    bundle = (F.when(k % 3 == 0, F.concat(F.col("c_name"), F.lit(" / 138"), F.lpad(k.cast("string"), 8, "0"), F.lit(" x")))
              .when(k % 3 == 1, F.concat(F.col("c_name"), F.lit("／0531-"), k)).otherwise(F.col("c_name")))
    name, phone = tx.split_contact(bundle)
    return t.customer.select("c_custkey", name.alias("name"), phone.alias("phone"))


@query("h14_strip_suffix_clause", "select c_custkey, case when c_custkey % 2 = 0 then c_name else c_name || ';' || c_mktsegment end as party from customer")
def h14(t):
    tail = F.when(F.col("c_custkey") % 2 == 0, "； 联系电话：0531").otherwise(F.concat(F.lit(";"), F.col("c_mktsegment")))
    return t.customer.select("c_custkey", tx.strip_suffix_clause(F.concat("c_name", tail)).alias("party"))


@query("h15_canonical_label", """
select p_partkey, case p_partkey % 4 when 0 then 'render_money' when 1 then 'project_number' when 2 then 'contact_name' else trim(regexp_replace(lower(p_type || ' ' || p_name), '[^0-9a-zA-Z]+', '_', 'g'), '_') end as field from part""")
def h15(t):
    k = F.col("p_partkey") % 4
    label = F.when(k == 0, " 中标金额（元）：").when(k == 1, "项目编号（建议书编号）").when(k == 2, "联系人/联系电话::").otherwise(F.concat(F.lit("-"), "p_type", F.lit(" / "), "p_name", F.lit("：")))
    return t.part.select("p_partkey", tx.canonical_label(label).alias("field"))


@query("h16_prefixed_value", "select p_partkey, case when p_size % 2 = 0 then p_name when p_size % 3 = 0 then p_brand else '' end as found from part")
def h16(t):
    items = F.array(F.col("p_type"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" 名称： "), "p_name")), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("单位："), "p_brand")))
    return t.part.select("p_partkey", tx.prefixed_value(F.array_compact(items), ["单位：", "名称："]).alias("found"))


@query("h17_split_title", "select p_partkey, case when p_size % 2 = 0 then '主任医师' else '' end as title, p_type || ',' || p_brand as others from part")
def h17(t):
    raw = F.concat(F.col("p_type"), F.lit("，"), F.when(F.col("p_size") % 2 == 0, "主任医师 / 医师,").otherwise(""), F.col("p_brand"), F.lit(" DEPT "), F.col("p_type"))
    title, others = tx.split_title(raw, F.lit("DEPT"))
    return t.part.select("p_partkey", title.alias("title"), others.alias("others"))


@query("h18_contained_title", """
select p_partkey, case p_size % 4 when 0 then '副主任医师' when 1 then '主任医师' when 2 then '医师' else '' end as contained, case p_size % 4 when 0 then '主任医师' when 1 then '主任医师' when 2 then '中医师' else p_name end as named from part""")
def h18(t):
    k = F.col("p_size") % 4
    job = F.when(k == 0, "科室副主任医师").when(k == 1, "主任医师、教授").when(k == 2, "中医师").otherwise(F.col("p_name"))
    heading = F.when(k == 0, "其他").when(k == 2, " ").otherwise(job)
    return t.part.select("p_partkey", tx.contained_title(job).alias("contained"),
                         tx.title_from_text(heading, F.when(k == 2, "擅长 中医师").otherwise("主任医师")).alias("named"))


@query("h19_gender_from_text", "select doc_id, case doc_id % 4 when 0 then '男' when 1 then '女' when 2 then '' else '男' end as gender from documents")
def h19(t):
    k = F.col("doc_id") % 4
    return t.documents.select("doc_id", tx.gender_from_text(F.when(k == 0, "男，1960").when(k == 1, F.concat("text", F.lit(" 女"))).when(k == 2, "男性").otherwise(F.concat("text", F.lit("，男　")))).alias("gender"))


@query("h20_guess_area", """
select s_suppkey, case s_suppkey % 4 when 0 then '历下区' when 1 then '宁州市' when 2 then '河口县' else 'city ' || s_nationkey end as area from supplier""")
def h20(t):
    k = F.col("s_suppkey") % 4
    address = F.when(k == 0, "东省宁州市历下区文一路").when(k == 1, "东省宁州市大街").otherwise("no tokens")
    name = F.when(k == 2, "河口县医院").otherwise("医院")
    return t.supplier.select("s_suppkey", tx.guess_area(address, name, F.concat(F.lit(" city  "), F.col("s_nationkey"))).alias("area"))


@query("h21_org_from_intro", "select s_suppkey, case s_suppkey % 3 when 0 then s_name when 1 then 'fb' else 'X' || s_nationkey end as org from supplier")
def h21(t):
    k = F.col("s_suppkey") % 3
    dept = F.concat(F.lit("科"), F.col("s_nationkey"))
    intro = (F.when(k == 0, F.concat(F.lit("某人现就职于 "), "s_name", F.lit(" "), dept, F.lit("主任"))).when(k == 1, F.concat(F.lit("曾任"), dept))
             .otherwise(F.concat(F.lit("就职于X"), F.col("s_nationkey"), dept, F.lit(" 现任"))))
    return t.supplier.select("s_suppkey", tx.org_from_intro(intro, dept, F.lit("fb")).alias("org"))


@query("h22_split_names", "select p_partkey, array_to_string(string_split(p_name, ' ') || [p_type, p_brand], '|') as names from part")
def h22(t):
    text = F.concat(F.replace("p_name", F.lit(" "), F.lit(" ，、 ")), F.lit(" ;\n;"), "p_type", F.lit("； "), "p_brand", F.lit(","))
    return t.part.select("p_partkey", F.array_join(tx.split_names(text), "|").alias("names"))


@query("h23_union_flag", """
select p_partkey, case when p_size % 4 = 0 then 1 else 0 end as by_comma, case when p_size % 4 in (0, 1, 2, 3) and p_size % 4 <> 3 then 1 else 0 end as by_name,
  case when p_size % 4 = 2 then 1 else 0 end as by_text from part""")
def h23(t):
    k = F.col("p_size") % 4
    name = F.concat(F.col("p_name"), F.when(k == 0, ",b").when(k == 1, "，b").when(k == 2, "联合体").otherwise(""))
    body = F.concat(name, F.when(k == 3, "不接受联合体").otherwise(""))
    return t.part.select("p_partkey", tx.union_flag(name, "comma").alias("by_comma"), tx.union_flag(name, "name").alias("by_name"), tx.union_flag(body, "text").alias("by_text"))


BOARD_RULES_A = [(("候选人", "预中标", "入围投标人"), words.CANDIDATE), (("中标", "成交", "合同", "履约", "结果"), words.WIN)]
BOARD_RULES_B = [(("需求", "意向", "计划"), words.INTENTION), (("候选人", "预中标", "入围投标人"), words.CANDIDATE), (("中标", "合同", "废标", "成交"), words.WIN)]
BOARD_RULES_C = [(("采购意向", "意向"), words.INTENTION), (("候选",), words.CANDIDATE), (("中标", "成交", "结果"), words.WIN), (("招标",), words.BID)]
NOTICE_NAME = """case p_size % 7 when 0 then '采购需求(意向)' when 1 then '中（定）标候选人公示' when 2 then '评标结果公示' when 3 then '合同及履约' when 4 then '采购计划' when 5 then '废标公告' else p_type end"""


@query("h24_classify_board", """
select p_partkey, case p_size % 7 when 0 then case when p_partkey % 2 = 0 then '采购意向' else '招标公告' end when 1 then '候选人公告' when 2 then '中标公告' when 3 then '中标公告' else '招标公告' end as by_module,
  case p_size % 7 when 0 then '采购意向' when 1 then '候选人公告' when 3 then '中标公告' when 4 then '采购意向' when 5 then '中标公告' else '招标公告' end as by_plan,
  case p_size % 7 when 0 then '采购意向' when 1 then '候选人公告' when 2 then '候选人公告' else '' end as by_map from part""")
def h24(t):
    name = F.expr(NOTICE_NAME)
    module = F.when(F.col("p_partkey") % 2 == 0, "政府采购").otherwise("工程建设")
    return t.part.select(
        "p_partkey", tx.classify_board(name, BOARD_RULES_A, words.BID, module=module, module_rule=(words.INTENTION_MODULES, ("需求", "意向"), words.INTENTION)).alias("by_module"),
        tx.classify_board(name, BOARD_RULES_B, words.BID).alias("by_plan"), tx.classify_board(name, BOARD_RULES_C, "", exact=words.NOTICE_BOARDS).alias("by_map"))


@query("h25_announcement_code", """
select p_partkey, case when p_size % 7 = 3 then 1 else 2 end as contract_code, case when p_size % 7 in (1, 2) then 2 else 1 end as result_code from part""")
def h25(t):
    name = F.expr(NOTICE_NAME)
    return t.part.select("p_partkey", tx.announcement_code(name, words.CONTRACT_WORDS, 1).alias("contract_code"), tx.announcement_code(name, words.RESULT_NOTICE_WORDS, 2).alias("result_code"))


@query("h26_normalize_method", "select event_id, case event_type when 'view' then '' when 'click' then '询价' when 'error' then '公开招标' else '其他类型' end as method from events")
def h26(t):
    raw = F.when(F.col("event_type") == "view", " ").when(F.col("event_type") == "click", " 询价 ").when(F.col("event_type") == "error", "采用公开招标方式").otherwise(F.col("event_type"))
    return t.events.select("event_id", tx.normalize_method(raw).alias("method"))


@query("h27_trade_type_gate", """
select o_orderkey, case when o_orderstatus = 'F' and o_orderpriority not in ('1-URGENT', '2-HIGH') then '' else o_orderpriority end as trade_type from orders""")
def h27(t):
    return t.orders.select("o_orderkey", tx.trade_type_gate(F.col("o_orderstatus"), F.col("o_orderpriority"), ["F"], ["1-URGENT", "2-HIGH"]).alias("trade_type"))


@query("h28_bracket_pair", "select c_custkey, case when c_custkey % 2 = 0 then c_mktsegment else '' end as region, case when c_custkey % 2 = 0 then c_name else '' end as method from customer")
def h28(t):
    text = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("x [ "), "c_mktsegment", F.lit("]["), "c_name", F.lit(" ] y"))).otherwise(F.concat(F.lit("["), "c_name", F.lit("] [x]")))
    region, method = tx.bracket_pair(text)
    return t.customer.select("c_custkey", region.alias("region"), method.alias("method"))


@query("h29_encode_body", "select page_id, to_base64(encode(html)) as body from pages")
def h29(t):
    return t.pages.select("page_id", tx.encode_body("html").alias("body"))


@query("h30_decode_numeric_bytes", """
with s as (select doc_id, text, hex(encode(text)) as h from documents where octet_length(encode(text)) < 50)
select doc_id, text from documents where octet_length(encode(text)) >= 50
union all select doc_id, case when text = '' then '' else array_to_string(list_transform(generate_series(1, length(h) // 2), lambda i: cast(cast('0x' || substr(h, cast(2 * i - 1 as int), 2) as int) as varchar)), chr(10)) end from s""")
def h30(t):
    pairs = F.split(F.rtrim(F.regexp_replace(F.hex(F.encode("text", "UTF-8")), "(..)", "$1 ")), " ")
    lines = F.transform(F.filter(pairs, lambda x: x != ""), lambda x: F.conv(x, 16, 10))
    return t.documents.select("doc_id", F.array_join(lines, "\n").alias("listed")).select("doc_id", tx.decode_numeric_bytes("listed").alias("text"))


@query("h31_unit_before_year", f"select doc_id, {squeezed('lang || source')} as unit from documents")
def h31(t):
    return t.documents.select("doc_id", tx.unit_before_year(F.concat("lang", "source", F.lit(" 2024年 "), "text")).alias("unit"))


@query("h32_string_bool", "select doc_id, case when quality = 0 then 'false' when toxic = 1 then '' else 'True' end as flag from labels")
def h32(t):
    return t.labels.select("doc_id", tx.string_bool(F.when(F.col("quality") == 0, False).when(F.col("toxic") == 1, F.lit(None)).otherwise(True)).alias("flag"))


@query("h33_safe_label", "select p_partkey, case when p_size % 2 = 0 then p_name else p_type || ' ' || p_name end as label from part")
def h33(t):
    title = F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit(" | · "), "p_name")).otherwise(F.concat(F.lit(" -"), "p_type", F.lit("  "), "p_name"))
    return t.part.select("p_partkey", tx.safe_label(title, F.col("p_brand")).alias("label"))
