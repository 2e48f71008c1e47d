"""Work that must not sit in one task, and markup at sizes and in forms that the pages of the queries do not show."""

from datetime import datetime

from harvestry.functions import markup as mk
from harvestry.functions.text import decode_numeric_bytes
from harvestry.operators.pages import extract_tables
from harvestry.plans import pages, text
from harvestry.plans.registry import Tables

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def orders(spark, folder, n):
    rows = [(k, k % 7, "O", 1.0, datetime(1997, 5, 28), "2-HIGH") for k in range(n)]
    spark.createDataFrame(rows, ORDERS).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return Tables(spark, str(folder))


def test_pages_made_of_one_split_are_dealt_out(spark, tmp_path):
    t = orders(spark, tmp_path, 400)
    assert t.orders.rdd.getNumPartitions() == 1
    busy = pages.notice_pages(t).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(busy) == 400 and max(busy) < 100


def test_plain_pages_are_read_as_by_the_library():
    inside = "<div a='1'><h1>T</h1><p>x &amp; y<br/></p><table><TR><td>1<td><b>2</b></td ></tr></table>z<script>var a='b';</script><img src=\"q\">w</div>"
    for page, plain in ((inside, True), (inside.replace("var", "<b>"), False), ("<p>a<!-- c --></p>", False), ("a < b", False), ("<title>t</title>", False)):
        parser, library = mk._Grid(), mk._Grid()
        assert mk._fed(parser, page) is plain
        library.feed(page)
        library.close()
        for what in ("tables", "parts"):
            assert mk._parsed(page, what) == library.result()[what]


def test_rare_entities_behind_removed_markup(one):
    for raw, lines in (("x &hellip; y", "x … y"), ("a &amp; b", "a & b"), ("&<script>1</script>hellip;", "…"), ("&hel<!-- c -->lip;", "…"), ("&am<!-- c -->p;", "&"), ("1 & 2", "1 & 2")):
        assert one(mk.plain_lines("h"), h=raw) == lines
    assert one(mk.extract_title("h"), h="<h1>a&hellip;</h1>") == "a…"


def test_blocks_named_in_other_case(one):
    assert one(mk.first_block("h", ["#none", ".wrap", "body"]), h='<!-- <p class="wrap"> --><BODY><Div CLASS="a WRAP">x<div></div></DIV>y</BODY>') == '<Div CLASS="a WRAP">x<div></div></DIV>'
    assert one(mk.first_block("h", [".wrap", "body"]), h="<BODY>x</BODY> wrap") == "<BODY>x</BODY>"
    assert one(mk.first_block("h", [".wrap", "body"]), h="wrap") == "wrap"


def test_table_rows_keep_their_places(spark):
    html = "<table><tr><td> </td></tr></table><table><tr><td></td></tr><tr><td>a</td></tr><tr><td> b </td><td>c</td></tr></table>"
    got = extract_tables(spark.createDataFrame([(1, html), (2, "none"), (3, None)], "k long, html string"), "k").orderBy("row_no").collect()
    assert [tuple(r) for r in got] == [(1, 1, 0, ["a"]), (1, 1, 1, ["b", "c"])]


def test_work_is_done_once(spark, tmp_path):
    """Costly columns are not copied into filters and branches; before, each of these plans had more."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    rows = spark.createDataFrame([(1, "<table></table>")], "k long, html string")
    assert "size(" not in plan(extract_tables(rows, "k")).split("Generate")[0]
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert plan(text.h30(Tables(spark, str(tmp_path)))).count("regexp_replace(hex(") == 1


def test_byte_lists(one):
    listed = lambda values: "\n".join(map(str, values))
    word = "é" * 40
    assert one(decode_numeric_bytes("t"), t=listed(word.encode())) == word
    assert one(decode_numeric_bytes("t"), t=listed(word.encode()) + "\n256\n65") == word
    assert one(decode_numeric_bytes("t"), t=" 065\r\n\n" + listed(word.encode())) == "A" + word
    assert one(decode_numeric_bytes("t"), t=listed(range(49))) == listed(range(49))
