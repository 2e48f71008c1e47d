"""Amounts written as text: numerals, units and the cascade that turns them into ``123元``."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.functions.text import any_contains, col, collapse, first_pattern, let, mapped, pick, strip
from harvestry.specs import words

NUMERALS = words.DIGIT_CHARS + "".join(words.SMALL_UNITS) + "".join(words.LARGE_UNITS)
EXACT = "decimal(38,8)"


def _unit_value(ch: Column, table: Mapping[str, int]) -> Column:
    return reduce(lambda acc, kv: acc.when(ch == kv[0], F.lit(kv[1]).cast("bigint")), table.items(), F.when(F.lit(False), F.lit(0).cast("bigint")))


def chinese_int(c: Column | str) -> Column:
    """Numerals to an integer. Units scale the digit before them (1 when missing); 万 and 亿 close a section."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("total"), zero.alias("section"), zero.alias("digit"))

    def step(acc: Column, ch: Column) -> Column:
        digit = F.when(F.lit(words.DIGIT_CHARS).contains(ch),
                       F.translate(ch, words.DIGIT_CHARS, words.DIGIT_VALUES).cast("bigint"))
        small, large = _unit_value(ch, words.SMALL_UNITS), _unit_value(ch, words.LARGE_UNITS)
        ones = F.when(acc.digit == 0, F.lit(1).cast("bigint")).otherwise(acc.digit)
        return F.struct(
            F.when(large.isNotNull(), acc.total + (acc.section + acc.digit) * large).otherwise(acc.total).alias("total"),
            F.when(large.isNotNull(), zero).when(small.isNotNull(), acc.section + ones * small)
            .otherwise(acc.section).alias("section"),
            F.when(digit.isNotNull(), digit).when(small.isNotNull() | large.isNotNull(), zero)
            .otherwise(acc.digit).alias("digit"),
        )

    chars = F.filter(F.split(F.coalesce(col(c), F.lit("")), ""), lambda x: x != "")
    return F.aggregate(chars, start, step, lambda acc: acc.total + acc.section + acc.digit)


def chinese_money(c: Column | str) -> Column:
    """Integer numerals plus tenths (角) and hundredths (分), as an exact decimal."""
    def value(text: Column) -> Column:
        digit = lambda unit: F.translate(pick(text, f"(?s)元.*?([{words.DIGIT_CHARS}]){unit}"), words.DIGIT_CHARS, words.DIGIT_VALUES)
        part = lambda unit, scale: F.coalesce(digit(unit).try_cast("decimal(4,0)"), F.lit(0)) * F.lit(scale).cast("decimal(4,2)")
        whole = chinese_int(F.substring_index(text, "元", 1)).cast("decimal(30,2)")
        return (whole + part("角", "0.1") + part("分", "0.01")).cast(EXACT)

    return let(F.regexp_replace(F.translate(F.coalesce(col(c), F.lit("")), "圆整正 ", "元"), "人民币", ""), value)


def number_text(c: Column) -> Column:
    """Plain digits without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(c.cast(EXACT).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def _yuan(c: Column) -> Column:
    return F.concat(c, F.lit("元"))


UNIT_FORM = r"^([-+]?\d+(?:\.\d+)?)([十百千万亿])元?$"
UNIT_SCALES = {"十": 10, "百": 100, "千": 1000, "万": 10000, "亿": 100000000}


def _written_amount(clean: Column) -> Column:
    """Digits of a plain, unit-scaled or written-out number; null when the text holds no numeral."""
    scale = _unit_value(F.regexp_extract(clean, UNIT_FORM, 2), UNIT_SCALES).cast("decimal(9,0)")
    scaled = F.regexp_extract(clean, UNIT_FORM, 1).try_cast("decimal(28,8)") * scale
    return (F.when(clean.rlike(r"^[-+]?\d+(?:\.\d+)?$"), number_text(clean.try_cast("decimal(30,8)")))
            .when(clean.rlike(UNIT_FORM), number_text(scaled))
            .when(clean.rlike(f"[{NUMERALS}]"), number_text(chinese_money(clean))))


def amount_text(c: Column | str) -> Column:
    """Any amount form to ``number元``; text that is a rate, has a slash or holds no amount comes back as it was."""
    raw = col(c)
    bare = F.regexp_replace(F.regexp_replace(strip(raw), r"[（(][^）)]*[）)]", ""), r"(?i)^(?:CNY|RMB)\s*", "")
    # Written-out amounts: the currency word and the closing mark go first.
    formal = lambda text: text.rlike("[壹贰叁肆伍陆柒捌玖拾佰仟万亿元整角分]") | text.contains("人民币")
    prepared = let(bare, lambda text: F.struct(
        text.alias("text"), formal(text).alias("formal"),
        F.when(formal(text), F.regexp_replace(F.regexp_replace(text, "^人民币", ""), "整", "")).otherwise(text).alias("body")))
    read = let(prepared, lambda p: F.struct(
        p.text.alias("text"), p.formal.alias("formal"), p.body.alias("body"), let(collapse(p.body), _written_amount).alias("written")))
    symbol = r"^[¥￥](\d+(?:\.\d+)?)$"
    grouped = r"^(\d{1,3}(?:,\d{3})*)(\.\d+)?元?$"
    amount = let(read, lambda r: F.when(r.text.rlike(r"^[\d,]+(?:\.\d+)?元?$"), F.translate(r.text, ",元", ""))
                 .when(r.formal & r.written.isNotNull(), r.written)
                 .when(r.body.rlike(symbol), pick(r.body, symbol))
                 .when(r.body.rlike(grouped), F.concat(F.translate(pick(r.body, grouped), ",", ""), pick(r.body, grouped, 2)))
                 .otherwise(r.written))
    kept = (F.instr(raw, "/") > 0) | any_contains(raw, words.RATE_WORDS)
    return F.when(kept, raw).otherwise(F.coalesce(_yuan(amount), raw))


def amount_decimal(c: Column | str) -> Column:
    """Numeric value of the amount; null when the text holds none."""
    return F.regexp_extract(amount_text(c), r"^([-+]?\d+(?:\.\d+)?)元$", 1).try_cast("decimal(20,4)")


def normalize_money(c: Column | str, variant: str = "signs") -> Column:
    """``signs`` drops separators, currency signs and 元 first; ``plain`` drops separators only; ``amount`` goes straight to the cascade."""
    dropped = {"signs": ",￥¥元", "plain": ","}.get(variant)

    def read(text: Column) -> Column:
        if dropped is None:
            return F.when(text == "", "").otherwise(amount_text(text))
        bare = strip(F.translate(text, dropped, ""))
        return F.when(text == "", "").when(bare.rlike(r"^\d+(?:\.\d+)?$"), _yuan(bare)).otherwise(amount_text(text))

    return let(F.coalesce(col(c), F.lit("")) if variant == "plain" else collapse(c), read)


def listing_price(c: Column | str) -> Column:
    """元 or 万元 amount; a whole number prints one decimal."""
    form = r"^(\d+(?:\.\d+)?)(万元|元)$"

    def read(text: Column) -> Column:
        scale = F.when(pick(text, form, 2) == "万元", 10000).otherwise(1)
        digits = number_text(F.regexp_extract(text, form, 1).try_cast("decimal(28,8)") * scale)
        shown = let(digits, lambda d: F.when(d.contains("."), d).otherwise(F.concat(d, F.lit(".0"))))
        return F.when(text == "", "").when(text.rlike(form), _yuan(shown)).otherwise(normalize_money(text))

    return let(F.translate(collapse(c), ",", ""), read)


def land_money(c: Column | str, unit: str = "万元") -> Column:
    """Amount over 10,000 with thousands commas and at most four decimals; raw text when not numeric."""
    def read(text: Column) -> Column:
        value = text.try_cast("decimal(30,8)")
        value = value / F.lit(10000) if unit == "万元" else value
        grouped = F.regexp_replace(F.format_number(F.round(value, 4), 4), r"(\.\d*?)0+$", "$1")
        return F.coalesce(F.concat(F.regexp_replace(grouped, r"\.$", ""), F.lit(unit)), text)

    return let(collapse(c), read)


def budget_from_text(c: Column | str) -> Column:
    """Labelled amount, else the first amount followed by 元."""
    return normalize_money(first_pattern(c, words.BUDGET_PATTERNS))


def listing_price_from_text(c: Column | str) -> Column:
    return listing_price(pick(c, words.LISTING_PRICE_PATTERN))


def range_text(low: Column, op: Column, op2: Column, high: Column, label: str) -> Column:
    """``low op label op2 high`` with glyphs for the comparison signs; '' when all parts are empty."""
    def glyph(c: Column) -> Column:
        return mapped(c, words.COMPARISON_GLYPHS, c)

    def show(r: Column) -> Column:
        return F.concat_ws(" ", F.when(r.lo != "", r.lo), F.when(r.o1 != "", glyph(r.o1)),
                           F.when(r.o2 != "", F.concat(F.lit(label + " "), glyph(r.o2))), F.when(r.hi != "", r.hi))

    parts = zip(("lo", "o1", "o2", "hi"), (low, op, op2, high))
    return let(F.struct(*[collapse(c).alias(n) for n, c in parts]), show)
