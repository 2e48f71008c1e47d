"""Texts derived from the given tables. The expressions run unchanged in Spark and in the SQL twin."""

# A tender notice per order: labelled lines, numbered sections, a contact pair and an amount.
NOTICE = """(case o_orderkey % 4 when 0 then '项目编号：JN-' || cast(o_orderkey as string) when 1 then '招标编号 : A' || cast(o_custkey as string)
  when 2 then 'ref SDGP' || cast(100000 + o_orderkey as string) || ' end' else 'none' end || chr(10)
 || case o_orderkey % 3 when 0 then '采购人名称：甲公司' || cast(o_custkey as string) || '； 联系人：王' when 1 then '招 标 人: 乙局' || cast(o_custkey as string) || ' 法定代表人：李' else '其他' end || chr(10)
 || case o_orderkey % 5 when 0 then '项目负责人：赵一 电 话：0531-' || cast(o_custkey as string) when 1 then '联系电话：１３８００' when 2 then '联系方式：无' else '' end || chr(10)
 || '预算金额：' || cast(o_custkey as string) || ',000.50元 合计 ' || cast(o_orderkey as string) || '元' || chr(10)
 || '挂牌价格：' || cast(o_orderkey as string) || case when o_orderkey % 2 = 0 then '.5万元' else '元' end || chr(10)
 || '发布 1997-05-28 10:20:00' || chr(10)
 || '1、采购人信息' || chr(10) || '名 称：丙校' || cast(o_custkey as string) || chr(10) || '2、代理机构' || chr(10) || '名 称：丁所' || chr(10)
 || '3、项目联系方式' || chr(10) || '项目联系人：孙' || cast(o_orderkey as string) || chr(10) || '电 话：1390000' || cast(1000 + o_custkey % 9000 as string))"""

# Amounts in every written form, from the order total.
AMOUNT = """case o_orderkey % 10 when 0 then cast(cast(o_totalprice as decimal(12,2)) as string) || '元' when 1 then '￥' || cast(o_custkey as string)
 when 2 then cast(o_custkey as string) || '.5万元' when 3 then '(含税)RMB ' || cast(o_custkey as string) when 4 then '下浮率' || cast(o_custkey as string)
 when 5 then cast(o_custkey as string) || '/年' when 6 then '人民币' || cast(o_custkey % 9 + 1 as string) || '亿元整' when 7 then '面议' || cast(o_custkey as string)
 when 8 then cast(o_custkey % 900 + 100 as string) || ',' || cast(o_orderkey % 900 + 100 as string) || '.25元' else '人民币贰拾万' || '叁仟元' || case when o_custkey % 2 = 0 then '伍角贰分' else '整' end end"""

# A notice page per order: breadcrumb, title, spans, two tables, files, pictures and script state.
_PARTS = [
    "'<html><head><title>公告-T{o}</title><style>p{{}}</style></head><body><nav class=\"position\"><a href=\"/\">首页</a>&gt;<a href=\"/d\">医生</a>&gt;<a href=\"/k\"> 科{c}</a></nav>'",
    "'<div class=\"wrap\"><h1>标题 {o}</h1><span class=\"l_span\">项目编号：</span><span class=\"r_span\">JN-{o}</span> <span class=\"l_span\">项目编号：</span> <span class=\"r_span\"><b>JN2-{o}</b></span>'",
    "'<p>前言{c}</p><table><tr><th>序号</th><th>中标单位</th><th>中标金额（元）</th></tr><tr><td>1</td><td> 公司<b>{c}</b></td><td>{s}</td></tr><tr><td></td><td> </td></tr><tr><td></td><td>乙</td><td>9</td></tr></table>'",
    "'<table><tr><td>采购人：</td><td>甲{c}</td><td>联系人</td><td>王</td></tr><tr><td>项目实施主体基本情况</td><td>名称</td><td>村{c}</td></tr><tr><td>联系人</td><td>李{o}</td></tr><tr><td>流转（需求）标的基本情况</td><td>名称</td><td>x</td></tr></table>'",
    "'<p>联系电话：0531-{c}</p><h3>医生简介</h3><div>-</div><p>简介<br>{s}</p><div class=\"i\"><span class=\"string\">职称：</span> 级{s}</div>'",
    "'<ul class=\"com-files\"><li><a href=\"/f/{o}.PDF\">文件 {o}</a></li><li><a href=\"/f/{o}.PDF\">again</a></li><li><a href=\"/download.do?id={o}\"></a></li><li><a href=\"/x.doc\">操作手册</a></li></ul>'",
    "'<img src=\"/logo.png\" alt=\"P{o}\"><img src=\"/img/p-{o}.jpg\" alt=\"P{c}\"><select id=\"kind\"><option value=\"\">不限</option><option value=\"k{s}\"> 类{s}</option><option value=\"z\">不限</option></select>'",
    "'<a class=\"downloadFileLink\" id=\"t1-{o}\"></a><span class=\"file-name\">a.csv</span><a class=\"downloadFileLink\" id=\"t2-{o}\"></a><span class=\"file-name\">b{c}.CSV</span>'",
    "'<script>var pid = ''{o}'';x.early=\"e\";window.__S=(function(a,b){{x.id=a;x.name=\"n\\\\u002Fm\";x.kind=b;x.none=null;}}(\"A{o}\",\"B{c}\"));</script></div></body></html>'",
]


def _fill(part: str) -> str:
    values = {"o": "' || cast(o_orderkey as string) || '", "c": "' || cast(o_custkey as string) || '", "s": "' || o_orderstatus || '"}
    return part.format(**values)


NOTICE_PAGE = " || ".join(_fill(p) for p in _PARTS)
