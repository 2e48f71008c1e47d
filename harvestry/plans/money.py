"""Amounts on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.functions import money
from harvestry.plans.inputs import AMOUNT, NOTICE
from harvestry.plans.registry import query

DIGITS = "['一','二','三','四','五','六','七','八','九']"
FORMAL = "['壹','贰','叁','肆','伍','陆','柒','捌','玖']"


def numeral(digits: str, units: str) -> str:
    """Portable numeral of ``n`` below 100 million, built digit by digit (digits that are zero are left out)."""
    q, b, s = units
    part = lambda v: " || ".join(
        f"case when floor({v} / {d}) % 10 > 0 then {pick_digit(digits, f'floor({v} / {d}) % 10')} || '{u}' else '' end" for d, u in ((1000, q), (100, b), (10, s), (1, "")))
    high = "floor(n / 10000)"
    return f"(case when n >= 10000 then {part(f'({high})')} || '万' else '' end || {part('(n % 10000)')})"


def pick_digit(digits: str, k: str) -> str:
    names = digits.strip("[]").replace("'", "").split(",")
    return "(case " + k + " " + " ".join(f"when {i} then '{d}'" for i, d in enumerate(names, 1)) + " else '' end)"


PLAIN_NUMERAL = numeral(DIGITS, "千百十")
FORMAL_NUMERAL = numeral(FORMAL, "仟佰拾")


@query("m1_chinese_int", """
select o_orderkey, cast(floor(o_totalprice) as bigint) as formal, cast(floor(o_totalprice) as bigint) as plain, case when o_orderkey % 2 = 0 then 12 else 100000005 end as short from orders""")
def m1(t):
    n = t.wide("orders").select("o_orderkey", F.floor("o_totalprice").alias("n"))
    return n.select("o_orderkey", money.chinese_int(F.expr(FORMAL_NUMERAL)).alias("formal"), money.chinese_int(F.expr(PLAIN_NUMERAL)).alias("plain"),
                    money.chinese_int(F.when(F.col("o_orderkey") % 2 == 0, "十二").otherwise("壹亿零伍")).alias("short"))


@query("m2_chinese_money", """
select o_orderkey, cast(floor(o_totalprice) + case o_orderkey % 3 when 0 then 0.52 when 1 then 0.3 else 0 end as double) as amount from orders""")
def m2(t):
    n = t.wide("orders").select("o_orderkey", F.floor("o_totalprice").alias("n"))
    tail = F.when(F.col("o_orderkey") % 3 == 0, "圆伍角贰分").when(F.col("o_orderkey") % 3 == 1, " 元叁角整").otherwise("元整")
    return n.select("o_orderkey", money.chinese_money(F.concat(F.lit("人民币"), F.expr(FORMAL_NUMERAL), tail)).cast("double").alias("amount"))


AMOUNT_VALUE = """case o_orderkey % 10 when 0 then cast(cast(o_totalprice as decimal(12,2)) as varchar) when 1 then cast(o_custkey as varchar) when 2 then cast(o_custkey * 10000 + 5000 as varchar)
 when 3 then cast(o_custkey as varchar) when 6 then cast((o_custkey % 9 + 1) * 100000000 as varchar) when 8 then cast(o_custkey % 900 + 100 as varchar) || cast(o_orderkey % 900 + 100 as varchar) || '.25'
 when 9 then case when o_custkey % 2 = 0 then '203000.52' else '203000' end end"""
AMOUNT_SQL = AMOUNT.replace("as string", "as varchar")


@query("m3_amount_text", f"select o_orderkey, coalesce({AMOUNT_VALUE} || '元', {AMOUNT_SQL}) as amount from orders")
def m3(t):
    return t.wide("orders").select("o_orderkey", money.amount_text(F.expr(AMOUNT)).alias("amount"))


@query("m4_amount_decimal", f"select o_orderkey, cast({AMOUNT_VALUE} as double) as amount from orders")
def m4(t):
    return t.wide("orders").select("o_orderkey", money.amount_decimal(F.expr(AMOUNT)).cast("double").alias("amount"))


@query("m5_normalize_money", f"""
select o_orderkey, coalesce({AMOUNT_VALUE} || '元', {AMOUNT_SQL}) as by_amount, coalesce({AMOUNT_VALUE} || '元', {AMOUNT_SQL}) as by_plain, coalesce({AMOUNT_VALUE} || '元', {AMOUNT_SQL}) as by_signs from orders""")
def m5(t):
    a = t.wide("orders").select("o_orderkey", F.expr(AMOUNT).alias("a"))
    return a.select("o_orderkey", *[money.normalize_money("a", v).alias(f"by_{v}") for v in ("amount", "plain", "signs")])


@query("m6_listing_price", """
select o_orderkey, case when o_orderkey % 2 = 0 then (o_orderkey * 10000 + 5000) || '.0元' else o_orderkey || '.0元' end as price from orders""")
def m6(t):
    return t.wide("orders").select("o_orderkey", money.listing_price_from_text(F.expr(NOTICE)).alias("price"))


@query("m7_land_money", """
select o_orderkey, case when o_orderkey % 5 = 0 then o_orderpriority else rtrim(rtrim(format('{:,.4f}', ((cast(cast(o_totalprice as decimal(14,2)) * 100 as bigint) + 50) // 100) / 10000.0), '0'), '.') || '万元' end as amount from orders""")
def m7(t):
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
    return t.wide("orders").select("o_orderkey", money.land_money(raw).alias("amount"))


@query("m8_budget_from_text", "select o_orderkey, o_custkey || '000.50元' as labelled, '7' || o_orderkey || '元' as first_amount from orders")
def m8(t):
    loose = F.concat(F.lit("共 7"), F.col("o_orderkey"), F.lit(" 元，另 9元"))
    return t.wide("orders").select("o_orderkey", money.budget_from_text(F.expr(NOTICE)).alias("labelled"), money.budget_from_text(loose).alias("first_amount"))


@query("m9_range_text", """
select p_partkey, case when p_size % 5 = 0 then '' else p_size || case p_size % 3 when 0 then ' ≤' when 1 then ' <' else '' end || ' 面积 ' || case when p_size % 2 = 0 then '≥' else '~' end || ' ' || p_size * 2 end as range_text from part""")
def m9(t):
    off = F.col("p_size") % 5 == 0
    show = lambda c: F.when(off, "").otherwise(c)
    op = F.when(F.col("p_size") % 3 == 0, "<=").when(F.col("p_size") % 3 == 1, " < ").otherwise("")
    op2 = F.when(F.col("p_size") % 2 == 0, ">=").otherwise("~")
    return t.part.select("p_partkey", money.range_text(show(F.col("p_size").cast("string")), show(op), show(op2), show((F.col("p_size") * 2).cast("string")), "面积").alias("range_text"))
