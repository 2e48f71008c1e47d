"""Long literals, nested script values, deep trees, and checks that pruning must not drop."""

import pytest
from pyspark.sql import functions as F

from harvestry import session
from harvestry.functions import jsonx, markup, text
from harvestry.operators.shaping import project
from harvestry.operators.trees import flatten_tree
from harvestry.sources import readers, writers

SCRIPT = """<script>window.__S__=(function(a,b,c,d,e){x.id=a;x.obj={k:1,f:function(){return 1;},s:"];"};x.kind=c;x.arr=[1,2];x.big="%s";x.q=e;x.in={g:function(){x.no=1;}};return {}}("A",{},"B",[1,2],'it;s'));</script>"""


def test_script_values_keep_their_places(spark):
    df = spark.createDataFrame([(SCRIPT % ("y" * 100_000),), (None,), ("",)], "html string")
    got = df.select(markup.script_aliases("html").alias("a"), markup.script_assignments("html", "x", markup.script_aliases("html")).alias("s")).collect()
    assert got[0].a == {"a": '"A"', "b": "{}", "c": '"B"', "d": "[1,2]", "e": "'it;s'"}
    s = got[0].s
    assert (s["id"], s["kind"], s["q"], s["arr"], len(s["big"])) == ("A", "B", "it;s", "[1,2]", 100_000)
    assert s["obj"] == '{k:1,f:function(){return 1;},s:"];"}' and s["in"] == "{g:function(){x.no=1;}}" and "no" not in s


def test_patterns_need_no_stack(spark, one):
    literal = '"' + 'z\\"' * 300_000 + '"'
    assert one(F.length(markup.split_script(F.col("t"), ";")[0]), t=f"q={literal};x") == len(literal) + 2
    assert one(text.labeled_value("t", "Tel:"), t="Tel:" + " " * 500_000 + "123<br>") == "123"
    assert one(text.labeled_value("t", "Tel:"), t="Tel:" + "<b></b>" * 50_000 + "x") == "x"
    assert one(text.labeled_value("t", "Tel:"), t="Tel: <br>") == ""


def test_texts_zero_and_false_are_texts(spark):
    v = spark.sql("""select parse_json('{"a":"0","b":"zz","c":0,"d":false,"e":"false","f":0.0,"g":""}') as v""")
    assert tuple(v.select(jsonx.text_at(F.col("v"), "a", "b"), jsonx.text_at(F.col("v"), "c", "d", "f", "g", "e"), jsonx.text_at(F.col("v"), "c", "b")).first()) == ("0", "false", "zz")


def test_checks_hold_without_their_columns(spark, tmp_path):
    df = spark.createDataFrame([("", "x")], "k string, v string")
    with pytest.raises(Exception, match="missing key"):
        project(df, {"key": "k", "val": "v"}, required=["key"]).select("val").collect()
    with pytest.raises(Exception, match="missing key"):
        project(df, {"key": "k", "val": "v"}, required=["key"]).count()
    spark.createDataFrame([("{}",), ("3",)], "value string").coalesce(1).write.text(str(tmp_path / "bad.jsonl"))
    with pytest.raises(Exception, match="not a JSON object"):
        readers.read_records(spark, str(tmp_path / "bad.jsonl")).count()


@pytest.mark.parametrize("body, good", [('[{"a":1},{"a":2}]', True), ('{"items":[{"a":1},{"a":2}]}', True), ('{"other":[1]}', False), ("[1,2]", False)])
def test_record_files(spark, tmp_path, body, good):
    (tmp_path / "r.json").write_text(body)
    read = lambda: readers.read_records(spark, str(tmp_path / "r.json")).count()
    if good:
        assert read() == 2
    else:
        with pytest.raises(Exception, match="no list of objects"):
            read()


def test_trees_order_and_cycles(spark):
    rows = [(1, None, 10000000000009), (2, None, 10000000000001), (3, 1, 5), (4, 1, 40), (5, 3, 1), (3, 5, 1)]
    got = flatten_tree(spark.createDataFrame(rows, "node long, parent long, place long"), "node", "parent", "place").orderBy("path").collect()
    assert [(r["node"], r["depth"]) for r in got] == [(2, 0), (1, 0), (3, 1), (5, 2), (4, 1)]


def test_a_shared_folder_is_asked_for(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.prepare_checkpoints(Session)


def test_failed_swap_puts_the_old_data_back(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    real = writers._fs

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def exists(self, path):
            return self.fs.exists(path)

        def rename(self, a, b):
            return False if "__new" in a.toString() else self.fs.rename(a, b)

    monkeypatch.setattr(writers, "_fs", lambda s, p: (Broken(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(RuntimeError, match="old data is back"):
        writers.safe_replace(spark.range(5), target, 5)
    assert spark.read.parquet(target).count() == 3


def test_query_parameters(one):
    from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

    from harvestry.functions.urls import set_query_param

    for url in ("HTTP://x.org/a?b=1&c=%E4%BD%A0+z&b=2&d&=e#f", "http://x.org", "http://x.org/?#", "?a=%zz&~*=~*", "x?b=9", ""):
        parts = urlsplit(url)
        want = urlunsplit(parts._replace(query=urlencode(dict(parse_qsl(parts.query, keep_blank_values=True)) | {"b": "n w", "é": "ü&"})))
        assert one(set_query_param("u", {"b": F.lit(" n  w "), "none": F.lit(" "), "é": F.lit("ü&")}), u=url) == want


def test_long_comments_need_no_stack(one):
    assert one(markup.clean_html("h"), h="<p>a</p><!--" + "x-" * 200_000 + "关闭本页 -->b") == "<p>a</p>b"
    assert "y" in one(markup.clean_html("h"), h="<!-- x -->y<p>关闭本页</p>")
