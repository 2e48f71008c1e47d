"""Page cleaning by whole nodes."""

import time

import pytest

from harvestry.functions import markup
from harvestry.functions.cleaning import clean_page, read

CASES = {
    # furniture goes with the tags nested in it; a keep-marker, or a block of its own, saves a node
    "<div>当前位置：<b>首页</b> &gt; <a href='/x'>建设</a></div><p>正文</p>": "<p>正文</p>",
    "<p>当前位置 <i>发布</i>人：甲</p>": "<p>当前位置 <i>发布</i>人：甲</p>",
    "<div>当前位置：首页<div>正文</div></div>": "<div>当前位置：首页<div>正文</div></div>",
    "<div><p>相关附件：</p><span>尊敬的用户您好！请看</span>正文</div>": "<div>正文</div>",
    "<td>请点击“我要参与”登录系统</td>": "<td>请点击“我要参与”登录系统</td>",
    "<p>CA办理及相关咨询请点击<a href='/q'>查看</a></p>x": "x",
    # buttons of any tag, the close link, the entry of changes
    "<button value='我要参与'><b>x</b></button><input value=\"澄清答疑\">y": "y",
    "<span onclick='window.close();'> 关闭本页 </span><span onclick='go()'>关闭</span>": "<span onclick='go()'>关闭</span>",
    "<li class='a bggg'>变更<b>公告</b></li><li class='bggg'>变更公告 1</li>": "<li class='bggg'>变更公告 1</li>",
    "<!-- 关闭本页 --><!-- x -->y": "<!-- x -->y",
    # the popup around the frame goes whole, one without it is brought to light
    "<div class='shows hide' style='display:none'>t<p><iframe id='cqdyifram'></iframe></p></div>z": "z",
    "<div class='shows hide' style='display: none; color:red'>t</div>": '<div class="shows " style="color:red">t</div>',
    "<div hidden class=hide>t</div><div hidden></div>": "<div>t</div><div hidden></div>",
    # files by address and by text, other anchors unwrapped
    "<a href='/a.PDF'>f</a><a href='/n'>PDF版招标文件下载</a><a href='/n'>keep <b>it</b></a>": "keep <b>it</b>",
    # stray and missing end tags
    "</div><div>当前位置：x<p>y": "</div>",
    "<p>当前位置：x<div>正文</div></p>": "<p>当前位置：x<div>正文</div></p>",
    "": "",
    "plain < text": "plain < text",
}


@pytest.mark.parametrize("page", CASES)
def test_clean_page(page):
    assert clean_page(page) == CASES[page]


def test_column_agrees_and_scripts_go(spark):
    rows = [(p,) for p in CASES] + [(None,), ("<script>'附件：'</script><a href='/n'>x</a><link href='y'>",)]
    got = {r["p"]: r["c"] for r in spark.createDataFrame(rows, "p string").select("p", markup.clean_html("p").alias("c")).collect()}
    assert got == CASES | {None: None, rows[-1][0]: "x"}


@pytest.mark.parametrize("page", ["<div>" * 40_000 + "附件：", "<p>当前位置：x</p>" * 60_000, "</b>" * 100_000 + "<i>" * 50_000, "<!-- x" * 50_000, "<a href='/f.pdf'>" * 40_000])
def test_long_and_deep_pages_are_read_in_time(page):
    start = time.process_time()
    clean_page(page)
    assert time.process_time() - start < 20


def test_nodes_without_end_reach_to_their_parents(spark):
    tags = [t for t in read("<div><p>a<br>b<p>c</div>d").tokens if hasattr(t, "page")]
    assert [(t.name, t.page.text[t.low : t.high]) for t in tags] == [("div", "abc"), ("p", "abc"), ("br", ""), ("p", "c")]
