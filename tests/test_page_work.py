"""Pages are read with few passes, and to the same values as by the longer ways."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from harvestry.functions import markup as mk
from harvestry.functions.text import collapse, first_non_empty, join_lines
from harvestry.operators import records as rc
from harvestry.plans import pages, records
from harvestry.plans.registry import Tables

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(k, k % 7, "O", 1.0, datetime(1997, 5, 28), "2-HIGH") for k in range(10)]
    spark.createDataFrame(rows, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    return Tables(spark, str(tmp_path))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


PIECES = "<div>a<p>b &amp; c</p><p>&nbsp;</p><div>d<table><tr><td>e<p>f</td></tr></table>g</div>h<br/><span/>i</div>j<script>k</script><style>l</style><DIV >m</DIV>n</p>"


@pytest.mark.parametrize("page,plain", [(PIECES, True), ("x > y", True), ("", True), (PIECES + "<table>o<div>p", True), ("<td>q</td><th>r", True), ("</table>s<table/>t", True), ("a < b", False), ("<p>u<", False),
                                        ("<script>v", False), ("<script>w<b></script>", False), ("<script a='1'>x</script>", False), ("<title>y</title>", False), ("<p>z<!-- c --></p>", False), ("<p a=1>b</p>", False)])
def test_parts_are_read_without_the_cells(page, plain):
    library = mk._Grid()
    library.feed(page)
    library.close()
    read = mk._plain_parts(page)
    assert (read is not None) is plain
    assert mk._parsed(page, "parts") == library.result()["parts"]


def test_parts_of_pages_in_order(spark):
    pages_ = spark.createDataFrame([(1, "<div><p>a</p><table></table>b</div>"), (2, None), (3, "<table>"), (4, "c<!-- --><table></table><p>d")], "k long, h string").coalesce(1)
    got = {r.k: r.p and [tuple(x) for x in r.p] for r in pages_.select("k", mk.parse_parts("h").alias("p")).collect()}
    assert got == {1: [(False, "a"), (True, "b")], 2: [], 3: [], 4: [(False, "c"), (True, "d")]}


def test_field_maps_share_their_sources(tables):
    """Spans, cells and lines are read once for both rules."""
    assert plan(pages.x11(tables)).count("regexp_extract_all(html") == 2  # tables and spans
    assert [tuple(r) for r in pages.x11(tables).filter("o_orderkey = 3").collect()] == [(3, "JN2-3", "JN-3", "甲3", "0531-3", "王")]


def test_irregular_tables_go_to_the_parser(spark):
    cases = {"<table><tr><td>a</td></tr></table>": True, "<TABLE a='b'><tbody>\n<tr><th>a<b>c</b></th> <td></td></tr></tbody></TABLE >": True, "<table><caption>x</caption><tr><td>a</td></tr></table>": True,
             "<table><tr><td>a</td></tr>": False, "<table><tr><td><table><tr><td>a</td></tr></table></td></tr></table>": False, "<table><tr><td>a</tr></table>": False, "<table><tr><td>&hellip;</td></tr></table>": False,
             "<table><tr><td><!-- <td> -->a</td></tr></table>": False, "<table><tr><td>a</td></tr></table><table>": False, "<table>" + "<tr><td>a</td></tr>" * 30000 + "</table>": True}
    rows = spark.createDataFrame(list(cases), "string").toDF("h")
    assert {r.h: r.flat for r in rows.select("h", mk.flat_tables("h").isNotNull().alias("flat")).collect()} == cases


def test_first_block_with_and_without_hidden_tags(one):
    block = lambda h, *s: one(mk.first_block("h", s), h=h)
    plain = '<style>a</style><div class="w">b<script>c</script><div></div></div>d'
    assert block(plain, ".w") == '<div class="w">b<script>c</script><div></div></div>'
    assert block(plain, "style") == plain  # hidden tags are no elements
    assert block('<script class="w">a</script><p class="w">b</p>', ".w") == '<p class="w">b</p>'


def test_files_are_read_for_title_and_text_alone(one):
    html = '<a href="/q" title="t">f</a><a title="u" href="/a.PDF">b <b>c</b></a><a href="/操作手册.doc">d</a><a href="">e</a>'
    assert [tuple(x) for x in one(mk.file_anchors("h"), h=html)] == [("/a.PDF", "u", "b c")]


def test_values_after_the_first_are_not_evaluated(one):
    assert one(first_non_empty(F.lit(" "), F.lit(" a "), F.raise_error(F.lit("evaluated")))) == "a"


def test_white_space(one):
    assert one(collapse("h"), h="　a\x1c\t b\xa0") == "a b"
    assert one(join_lines("h"), h=" \n a  b　c \r\n\n  d e\x85") == "a b c\nd e"
    assert one(mk.plain_lines("h"), h="<p> a</p> <p>b</p>c <b>d</b>") == "a\nb\nc\nd"


def test_context_cleans_tables_once(tables):
    assert plan(records.b1(tables)).count("transform(coalesce(_flat#") == 1


def test_context_is_written_without_the_raw_page(tables, monkeypatch):
    written, write = [], rc.write_routed
    monkeypatch.setattr(rc, "write_routed", lambda df, *rest: written.extend(df.columns) or write(df, *rest))
    assert records.b6(tables).count() == 10
    assert "main_html" in written and "html" not in written
