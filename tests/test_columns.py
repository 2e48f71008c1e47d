"""Column functions on literals, and properties that must always hold."""

import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harvestry.functions import dates, jsonx, markup, money, text, urls
from harvestry.specs import words

quick = settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.mark.parametrize("raw,want", [
    ("12/3", "12/3"), ("费率5%", "费率5%"), ("1,234.50元", "1234.50元"), ("人民币贰拾万元整", "200000元"), ("￥210000", "210000元"), ("21万元", "210000元"),
    ("(含税)柒仟贰佰肆拾元整", "7240元"), ("壹佰元伍角贰分", "100.52元"), ("十二", "12元"), ("面议", "面议"), ("CNY 300", "300元"), ("", "")])
def test_amount_text(one, raw, want):
    assert one(money.amount_text("a"), a=raw) == want


@pytest.mark.parametrize("raw,want", [("一千零五万三千", 10053000), ("壹亿零伍", 100000005), ("十", 10), ("百二", 102), ("", 0), ("abc", 0)])
def test_chinese_int(one, raw, want):
    assert one(money.chinese_int("a"), a=raw) == want


@pytest.mark.parametrize("raw,want", [("5万元", "50000.0元"), ("1,234.5元", "1234.5元"), ("", ""), ("三元", "3元")])
def test_listing_price(one, raw, want):
    assert one(money.listing_price("a"), a=raw) == want


def test_emptiness_has_three_meanings(one):
    assert one(text.is_blank("a"), a="　 ") and not one(text.is_blank("a"), a="0")
    assert one(text.is_falsy(F.lit(0), "number")) and not one(text.is_empty_strict(F.lit(0), "number"))
    assert one(text.norm_text("a", null_words=True), a=" None ") == "" and one(text.norm_text("a"), a=" None ") == "None"


@pytest.mark.parametrize("raw,want", [("2024-1-5", "2024-01-05"), ("2024-01-05 23:59:59", "2024-01-05"), ("2024-02-30", "2024-02-30"), ("2024-01-05 25:00:00", "2024-01-05 25:00:00"), (" x ", "x")])
def test_iso_date(one, raw, want):
    assert one(dates.iso_date("a"), a=raw) == want


@pytest.mark.parametrize("base,href,want", [
    ("http://a.b/c/d", "../e", "http://a.b/e"), ("http://a.b/c/d", "/e?x", "http://a.b/e?x"), ("http://a.b/c/d", "f", "http://a.b/c/f"),
    ("http://a.b/c", "//x.y/z", "http://x.y/z"), ("http://a.b/c", "https://q.r", "https://q.r"), ("http://a.b/c", "?p=2", "http://a.b/c?p=2")])
def test_absolute_url(one, base, href, want):
    assert one(urls.absolute_url("b", "h"), b=base, h=href) == want


@pytest.mark.parametrize("url,mime,want", [("http://a/x.PNG?y", "", "p/7.png"), ("http://a.b/x", "image/png", "p/7.png"), ("http://a.b/.hid", "", "p/7.jpg")])
def test_object_key(one, url, mime, want):
    assert one(urls.object_key(F.lit(7), F.col("u"), F.col("m"), "p"), u=url, m=mime) == want


def test_numeric_bytes(one):
    body = "﻿" + "医院abc" * 10
    lines = "\n".join(str(b) for b in body.encode())
    assert one(text.decode_numeric_bytes("a"), a=lines) == body[1:]
    assert one(text.decode_numeric_bytes("a"), a="1\n2\n3") == "1\n2\n3"


def test_section_and_contact(one):
    notice = "1、采购人信息\n名 称：甲校\n2、代理\n名称：乙\n3、项目联系方式\n联系人：王一\n电话：0531-1"
    assert one(text.section_value("a", "采购人信息", r"名\s*称", "[23]", "1"), a=notice) == "甲校"
    assert one(text.section_value("a", "项目联系方式", "联系人", "[45]", "3"), a=notice) == "王一"
    assert one(text.extract_phone("a"), a=notice) == "0531-1"


def test_paths_read_objects_and_lists(one):
    v = jsonx.parse_payload("a")
    assert one(jsonx.get_path(v, "m.0", "string"), a='{"m":{"0":"k"}}') == "k"
    assert one(jsonx.get_path(v, "m.0", "string"), a='{"m":["l"]}') == "l"
    assert one(jsonx.get_path(v, "m", "json"), a='{"m":null}') is None
    assert one(F.to_json(v), a="{broken") == "{}"
    assert one(jsonx.canonical_json(v), a='{"b":1,"a":[2]}') == one(jsonx.canonical_json(v), a='{"a":[2],"b":1}')


def test_nested_tables_and_rare_entities_use_the_parser(spark):
    page = "<div><table><tr><td>a&copy;<table><tr><td>in</td></tr></table></td><td>b</table></div>"
    df = spark.createDataFrame([(page,), ("<table><tr><td>x</td></tr></table>",), ("none",)], "html string")
    got = [r.tables for r in markup.parse_tables(df, "html").collect()]
    assert got == [[[["a© in", "in", "b"], ["in"]], [["in"]]], [[["x"]]], []] or got[0][1] == [["in"]]
    assert got[1] == [[["x"]]] and got[2] == []


def test_first_block_counts_nesting_and_ignores_scripts(one):
    page = '<body><script>"</div>"</script><!-- <div class="m"> --><div class="a m">x<div>y</div><script>"</div>"</script>z</div><div>t</div></body>'
    assert one(markup.first_block("a", ["#no", ".m", "body"]), a=page) == '<div class="a m">x<div>y</div><script>"</div>"</script>z</div>'
    assert one(markup.first_block("a", ["#no"]), a="plain") == "plain"


def test_clean_html(one):
    page = ('<html><script>1</script><div hidden class="hide x" style="display:none;color:red">正文<p>当前位置：首页</p><p>当前位置 发布人：甲</p>'
            '<a href="/a.PDF">f</a><a href="/n">keep</a></div></html>')
    assert one(markup.clean_html("a"), a=page) == '<html><div class=" x" style="color:red">正文<p>当前位置 发布人：甲</p>keep</div></html>'


def test_content_mix_keeps_blank_cells(spark):
    html_text = "<div><h1>T</h1><p>before</p><table><tr><th>a</th><th>b</th></tr><tr><td></td><td>1</td></tr></table><p>after</p></div>"
    df = markup.parse_tables(spark.createDataFrame([(html_text,)], "html string"), "html").withColumn("parts", markup.parse_parts("html"))
    m = df.select(markup.content_mix(F.col("tables"), F.col("parts"), F.lit("T")).alias("m")).first().m
    assert (m.before, m.head, m.body, m.after) == ("before", ["a", "b"], [["", "1"]], "after")


alphabet = st.text(st.sampled_from(list(" 　 ab1医.,★'-\n&;lt")), max_size=12)


@quick
@given(st.lists(alphabet, min_size=200, max_size=200))
def test_edge_noise_is_a_fixed_point(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a string").select(text.strip_edge_noise("a").alias("b")).select("b", text.strip_edge_noise("b").alias("c"))
    assert df.filter("b <> c").count() == 0


@quick
@given(st.lists(alphabet, min_size=200, max_size=200))
def test_norm_text_like_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a string").select("a", text.norm_text("a").alias("b"))
    assert all(r.b == " ".join(html.unescape(r.a).split()) for r in df.collect())


@quick
@given(st.lists(st.integers(0, 99_999_999), min_size=200, max_size=200))
def test_numerals_round_trip(spark, values):
    def spell(n):
        def section(m):
            out = "".join("零一二三四五六七八九"[d] + u for d, u in zip(map(int, f"{m:04d}"), ("千", "百", "十", "")) if d)
            return out
        return (section(n // 10000) + "万" if n >= 10000 else "") + section(n % 10000)
    df = spark.createDataFrame([(n, spell(n)) for n in values], "n bigint, s string")
    assert df.filter(money.chinese_int("s") != F.col("n")).count() == 0


def test_word_lists_are_consistent():
    assert len(words.DIGIT_CHARS) == len(words.DIGIT_VALUES)
    assert {a for m in words.ALLOWED_MOVES for a in m} <= set(words.TASK_STATES)
