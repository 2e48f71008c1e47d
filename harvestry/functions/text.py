"""Text columns: emptiness, normalising, cleaning and pattern picks."""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from harvestry.specs import words

# Every character the source treats as white space. Java's \s covers ASCII only; this class is two cheap tests per character.
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
CJK = r"\x{4e00}-\x{9fff}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Compute ``value`` once and use it many times in ``body``.

    A Column used in several branches is copied into each of them; nested functions would multiply
    the copies. A lambda variable is a reference instead. ``body`` must stay free of Python UDFs.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def one_of(values: Sequence[str]) -> str:
    """Regex alternation that matches the values literally."""
    return "|".join(re.escape(v) for v in values)


def any_contains(c: Column, values: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(v) for v in values], F.lit(False))


# --- emptiness ---------------------------------------------------------------
def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(c: Column | str) -> Column:
    """Null or nothing but white space. ``0`` and ``false`` as text are not blank."""
    c = col(c)
    return c.isNull() | ~c.rlike(f"[^{SPACE}]")


def is_empty_strict(c: Column | str, kind: str = "string") -> Column:
    """Null, blank string or empty container; numbers and booleans are never empty."""
    c = col(c)
    if kind == "string":
        return is_blank(c)
    if kind == "container":
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def is_falsy(c: Column | str, kind: str = "string") -> Column:
    """Skipped by an ``a or b`` chain: null, '', zero, false, empty container."""
    c = col(c)
    if kind == "string":
        return c.isNull() | (c == "")
    if kind == "container":
        return c.isNull() | (F.size(c) == 0)
    if kind == "boolean":
        return c.isNull() | ~c
    return c.isNull() | (c == 0)


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


# --- normalising -------------------------------------------------------------
@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


BASIC_ENTITIES = {"&nbsp;": "\u00a0", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}
OTHER_ENTITY = "&(?!(?:nbsp|lt|gt|quot|#39|apos|amp);)[A-Za-z#]"


def basic_entities(c: Column) -> Column:
    """The everyday entities only; the ampersand goes last, so nothing is decoded twice."""
    decoded = lambda text, name, char: let(text, lambda x: F.when(x.contains(name), F.replace(x, F.lit(name), F.lit(char))).otherwise(x))
    return reduce(lambda acc, kv: decoded(acc, *kv), BASIC_ENTITIES.items(), c)


def may_hold_entities(page: Column | str) -> Column:
    """Whether text cut out of the page's markup can hold a rare entity: what follows its ampersand may stand behind a tag or comment."""
    return col(page).contains("&") & col(page).rlike(OTHER_ENTITY[:-1] + "<]")


def unescape_html(c: Column | str, suspect: Column | None = None) -> Column:
    """All HTML5 entities. Rows with everyday entities stay in the JVM and send only a null to Python.

    ``c`` is evaluated below the Python step and again above it. Where that is costly, ``suspect`` names the rows that can hold rare entities;
    on others only the second evaluation takes place.
    """
    rare = let(col(c), lambda x: F.when(x.rlike(OTHER_ENTITY), x))
    rare = rare if suspect is None else F.when(suspect, rare)
    plain = let(col(c), lambda x: F.when(x.contains("&"), basic_entities(x)).otherwise(x))
    return F.coalesce(_unescape(rare), plain)


def collapse(c: Column | str) -> Column:
    """Runs of white space to one blank, ends stripped, null to ''."""
    return F.coalesce(F.trim(F.regexp_replace(col(c), f"[{SPACE}]+", " ")), F.lit(""))


def norm_text(c: Column | str, null_words: bool = False, entities: bool = True, suspect: Column | None = None) -> Column:
    c = col(c)
    cleaned = collapse(unescape_html(c, suspect) if entities else c)
    if not null_words:
        return cleaned
    return F.when(F.lower(strip(c)).isin("none", "null"), F.lit("")).otherwise(cleaned)


def norm_multiline(c: Column | str) -> Column:
    """Line breaks unified, blanks squeezed, at most one empty line in a row."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    return strip(F.regexp_replace(text, f"\n[{SPACE}]*\n+", "\n\n"))


def html_multiline(c: Column | str) -> Column:
    """Markup to lines: ``<br>`` and paragraph seams become line breaks, each line stripped."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?i)<br\s*/?>", "\n")
    text = F.regexp_replace(text, r"(?i)</p>\s*\n\s*<p[^>]*>", "\n\n")
    text = F.regexp_replace(text, r"(?i)</p>\s*<p[^>]*>", "\n")
    text = unescape_html(F.regexp_replace(text, r"<[^>]+>", ""))
    text = F.regexp_replace(text, "\r", "")
    text = F.regexp_replace(text, f"[{SPACE}&&[^\n]]*\n[{SPACE}&&[^\n]]*", "\n")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def join_lines(c: Column | str, entities: bool = True, suspect: Column | None = None) -> Column:
    """Every non-blank line, normalised, joined by a line break. Works on the whole text at once, not line by line; texts without other white space than single
    blanks and line breaks skip the replacements."""
    text = F.coalesce(col(c), F.lit(""))
    text = unescape_html(text, suspect) if entities else text
    broken = lambda x: F.regexp_replace(x, r"[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]", "\n")
    even = let(text, lambda x: F.when(x.rlike(f"[{SPACE}&&[^\n ]]|  "), F.regexp_replace(broken(x), f"[{SPACE}&&[^\n]]+", " ")).otherwise(x))
    return F.btrim(let(even, lambda x: F.when(x.rlike(r" \n|\n[\n ]"), F.regexp_replace(x, r" ?\n[\n ]*", "\n")).otherwise(x)), F.lit("\n "))


def strip_tags(c: Column | str, sep: str = "", entities: bool = True) -> Column:
    return norm_text(F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", sep), entities=entities)


# --- cleaning ----------------------------------------------------------------
def _char_class(chars: str) -> str:
    return "".join("\\" + ch if ch in r"\^-[]&" else ch for ch in chars)


def strip_edge_noise(c: Column | str) -> Column:
    """Punctuation, decorations and blanks off both ends (the fixed point), inner blanks collapsed."""
    noise = _char_class(words.EDGE_NOISE_CHARS + words.DECORATIVE_CHARS) + SPACE
    return collapse(F.regexp_replace(F.coalesce(col(c), F.lit("")), f"^[{noise}]+|[{noise}]+$", ""))


def match_key(c: Column | str) -> Column:
    """Comparison form of a name: digits, Latin letters and CJK only."""
    return F.regexp_replace(strip_edge_noise(c), f"[^0-9A-Za-z{CJK}]+", "")


def remove_chars(c: Column | str, chars: str = words.REMOVED_CHARS) -> Column:
    return F.translate(collapse(c), chars, "")


def drop_lines(c: Column | str, unwanted: Sequence[str]) -> Column:
    lines = F.transform(F.split(F.coalesce(col(c), F.lit("")), "\n"), strip)
    kept = F.filter(lines, lambda x: (x != "") & ~x.isin(*unwanted))
    return F.array_join(kept, "\n")


# --- pattern picks -----------------------------------------------------------
def pick(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of the group, or ''."""
    return F.coalesce(F.regexp_extract(col(c), pattern, group), F.lit(""))


def first_non_empty(*cols: Column | str, entities: bool = False) -> Column:
    """First argument with text left after normalising, else ''. Later ones are not evaluated."""
    return F.coalesce(*[_non_empty(norm_text(c, entities=entities)) for c in cols], F.lit(""))


def labeled_value(c: Column | str, label: str, entities: bool = True) -> Column:
    """Text after the label, past blanks and tags, up to the next tag or line end."""
    # Possessive, so that any number of blanks needs no stack; blanks alone are an empty value.
    pattern = rf"(?i)\Q{label}\E(?:(?:[{SPACE}]|&nbsp;|<[^>]+>)*+([^<\r\n]+)|(?=(?:<[^>]+>)*+(?:[{SPACE}]|&nbsp;)))"
    return norm_text(pick(c, pattern), entities=entities)


def first_pattern(c: Column | str, patterns: Sequence[str]) -> Column:
    """Ordered patterns; the first non-blank group wins."""
    return let(col(c), lambda text: F.coalesce(*[_non_empty(collapse(pick(text, "(?s)" + p))) for p in patterns], F.lit("")))


def _non_empty(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def section_text(c: Column | str, heading: str, stops: str, number: str = "") -> Column:
    """Body of one numbered section: from its heading to the next heading in ``stops`` or the end."""
    lead = rf"(?:^|\n)\s*{number}\s*[\.、]\s*" if number else ""
    return pick(c, rf"(?s){lead}{heading}\s*(.*?)(?=(?:\n\s*{stops}\s*[\.、])|$)")


def section_value(c: Column | str, heading: str, label: str, stops: str, number: str = "", value: str = r"([^\n]+)") -> Column:
    """A label's value inside one section only."""
    return collapse(pick(section_text(c, heading, stops, number), rf"{label}\s*[：:]\s*{value}"))


def extract_project_no(c: Column | str) -> Column:
    return first_pattern(c, words.PROJECT_NO_PATTERNS)


def strip_suffix_clause(c: Column | str) -> Column:
    """Cut the "; contact: …" tail off a party name."""
    return collapse(F.regexp_replace(collapse(c), words.CONTACT_SUFFIX, ""))


def extract_party(c: Column | str) -> Column:
    found = let(col(c), lambda text: F.coalesce(*[_non_empty(pick(text, p)) for p in words.PARTY_PATTERNS], F.lit("")))
    return strip_suffix_clause(F.substring_index(found, words.PARTY_CUT, 1))


def extract_phone(c: Column | str) -> Column:
    return first_pattern(c, words.PHONE_PATTERNS)


def extract_contact(c: Column | str) -> Column:
    return first_pattern(c, words.CONTACT_PATTERNS)


def split_contact(c: Column | str) -> tuple[Column, Column]:
    """``name/phone`` to two columns; both '' when the text has no such pair."""
    text, pattern = collapse(c), r"([^/／]+)[/／]\s*(1\d{10}|0\d[\d\-]+)"
    return collapse(pick(text, pattern, 1)), pick(text, pattern, 2)


def mapped(c: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Constant lookup table as a CASE; ``default`` on a miss (null when not given)."""
    def chain(key: Column) -> Column:
        return reduce(lambda acc, kv: acc.when(key == kv[0], F.lit(kv[1])), table.items(), F.when(F.lit(False), ""))

    hit = let(c, chain)
    return hit if default is None else F.coalesce(hit, default)


def canonical_label(c: Column | str, table: Mapping[str, str] = words.FIELD_NAMES) -> Column:
    """Known labels to field names; others to a lower-case underscore form."""
    snake = lambda name: F.regexp_replace(F.lower(name), f"[^0-9a-zA-Z{CJK}]+", "_")
    clean = F.regexp_replace(F.translate(collapse(c), "（）", "()"), "[：:]+$", "")
    return let(clean, lambda name: mapped(name, table, F.regexp_replace(snake(name), "^_+|_+$", "")))


def prefixed_value(items: Column | str, prefixes: Sequence[str]) -> Column:
    """Remainder of the first item that starts with one of the prefixes."""
    normed = F.transform(col(items), collapse)
    starts = lambda x: reduce(lambda a, b: a | b, [x.startswith(p) for p in prefixes])
    hit = F.try_element_at(F.filter(normed, starts), F.lit(1))
    return F.coalesce(collapse(F.regexp_replace(hit, f"^(?:{one_of(prefixes)})", "")), F.lit(""))


def split_title(c: Column | str, department: Column, titles: Sequence[str] = words.MEDICAL_TITLES) -> tuple[Column, Column]:
    """(first known title, the other distinct parts joined by ',' without the department)."""
    parts = F.split(F.coalesce(col(c), F.lit("")), f"[，,/{SPACE}]+")
    parts = F.filter(parts, lambda x: (x != "") & ((department == "") | (x != department)))
    known = F.try_element_at(F.filter(parts, lambda x: x.isin(*titles)), F.lit(1))
    others = F.array_distinct(F.filter(parts, lambda x: ~x.isin(*titles)))
    return F.coalesce(known, F.lit("")), F.array_join(others, ",")


def contained_title(c: Column | str, titles: Sequence[str] = words.CONTAINED_TITLES) -> Column:
    """First title of the ordered list that the text contains."""
    return let(collapse(c), lambda text: F.coalesce(*[F.when(text.contains(t), F.lit(t)) for t in titles], F.lit("")))


def title_from_text(title: Column | str, intro: Column | str, alternatives: str = words.TITLE_ALTERNATIVES,
                    other: str = words.OTHER_TITLE) -> Column:
    """Title named in the heading, the heading itself, else a title named in the intro."""
    named = f"({alternatives})"
    return let(collapse(title), lambda head: F.when(
        (head != "") & (head != other), F.coalesce(_non_empty(pick(head, named)), head)).otherwise(pick(intro, named)))


def gender_from_text(c: Column | str, markers: Sequence[str] = ("男", "女")) -> Column:
    """A marker standing alone between separators."""
    padded = F.concat(F.lit(" "), F.coalesce(col(c), F.lit("")), F.lit(" "))
    return pick(padded, f"[，,{SPACE}]({'|'.join(markers)})[，,{SPACE}]")


def guess_area(address: Column, name: Column, city: Column) -> Column:
    """Last district of the address, else its last city, else a district in the name, else the city."""
    tokens = F.regexp_extract_all(F.coalesce(address, F.lit("")), F.lit(f"([{CJK}]+?(?:省|市|区|县))"), 1)
    named = F.regexp_extract_all(F.coalesce(name, F.lit("")), F.lit(f"([{CJK}]+?(?:区|县))"), 1)
    last = lambda arr: F.try_element_at(arr, F.lit(-1))
    return F.coalesce(
        last(F.filter(tokens, lambda x: x.endswith("区") | x.endswith("县"))),
        last(F.filter(tokens, lambda x: x.endswith("市"))),
        last(named),
        collapse(city),
    )


def org_from_intro(intro: Column, department: Column, fallback: Column,
                   leads: Sequence[str] = ("现就职于", "现任", "就职于")) -> Column:
    """Organisation named between a lead phrase and the row's own department."""
    def between(row: Column, lead: str) -> Column:
        start = F.locate(lead, row.text)
        rest = F.substring(row.text, start + len(lead), F.length(row.text))
        stop = F.call_function("locate", row.dept, rest, F.lit(2))
        return F.when((row.dept != "") & (start > 0) & (stop > 1), collapse(F.substring(rest, F.lit(1), stop - 1)))

    both = F.struct(collapse(intro).alias("text"), collapse(department).alias("dept"))
    return F.coalesce(let(both, lambda row: F.coalesce(*[between(row, lead) for lead in leads])), fallback)


def split_names(c: Column | str) -> Column:
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), "[，,；;、\n]+"), strip)
    return F.filter(parts, lambda x: x != "")


def union_flag(c: Column | str, variant: str) -> Column:
    """1 when a win is shared. ``comma``: comma in the name; ``name``: comma or the union word; ``text``: mention, unless denied."""
    rules = {
        "comma": lambda text: text.contains(","),
        "name": lambda text: any_contains(text, (",", "，", words.UNION_WORD)),
        "text": lambda text: text.contains(words.UNION_WORD) & ~any_contains(text, words.UNION_DENIALS),
    }
    return let(collapse(c), lambda text: F.when(rules[variant](text), 1).otherwise(0))


def classify_board(name: Column, rules: Sequence[tuple[Sequence[str], str]], default: str,
                   exact: Mapping[str, str] | None = None, module: Column | None = None,
                   module_rule: tuple[Sequence[str], Sequence[str], str] | None = None) -> Column:
    """Ordered keyword rules. Exact names win when given; a module-bound rule goes first when given."""
    def decide(text: Column) -> Column:
        chain = F.when(F.lit(False), "")
        for label, board in (exact or {}).items():
            chain = chain.when(text == label, board)
        if module is not None and module_rule:
            modules, keywords, board = module_rule
            chain = chain.when(module.isin(*modules) & any_contains(text, keywords), board)
        for keywords, board in rules:
            chain = chain.when(any_contains(text, keywords), board)
        return chain.otherwise(default)

    return let(name, decide)


def announcement_code(c: Column | str, keywords: Sequence[str], hit: int) -> Column:
    """``hit`` when a keyword occurs, else the other one of 1 and 2."""
    return let(collapse(c), lambda text: F.when(any_contains(text, keywords), hit).otherwise(3 - hit))


def normalize_method(c: Column | str, methods: Sequence[str] = words.PROCUREMENT_METHODS,
                     other: str = words.OTHER_METHOD) -> Column:
    """Exact name, else the first listed name it contains, else 'other'; blank stays blank."""
    def decide(text: Column) -> Column:
        chain = F.when(text == "", "").when(text.isin(*methods), text)
        for method in methods:
            chain = chain.when(text.contains(method), method)
        return chain.otherwise(other)

    return let(collapse(c), decide)


def trade_type_gate(module: Column, trade_type: Column, gated: Sequence[str], allowed: Sequence[str]) -> Column:
    """A whitelist that binds only some modules."""
    return let(collapse(trade_type), lambda kind: F.when(module.isin(*gated) & ~kind.isin(*allowed), "").otherwise(kind))


def bracket_pair(c: Column | str) -> tuple[Column, Column]:
    pattern = r"\[([^\[\]]+)\]\[([^\[\]]+)\]"
    return collapse(pick(c, pattern, 1)), collapse(pick(c, pattern, 2))


def encode_body(c: Column | str) -> Column:
    """UTF-8 text to one base64 line; '' for empty."""
    body = F.coalesce(col(c), F.lit(""))
    return F.regexp_replace(F.base64(F.encode(body, "UTF-8")), "[\r\n]", "")


BYTE_RUN_MIN = 50
BYTE_VALUES = {str(i): i for i in range(256)}


@F.pandas_udf(StringType())
def _from_byte_lines(values: pd.Series) -> pd.Series:
    def one(text):
        lines = text.split("\n")
        if len(lines) >= BYTE_RUN_MIN:
            try:  # nothing but plain byte values
                return bytes(map(BYTE_VALUES.__getitem__, lines)).decode("utf-8-sig", errors="ignore")
            except KeyError:
                pass
        stripped = filter(None, map(str.strip, text.splitlines()))
        run = list(itertools.takewhile(lambda s: s.isdigit() and int(s) < 256, stripped))
        return bytes(map(int, run)).decode("utf-8-sig", errors="ignore") if len(run) >= BYTE_RUN_MIN else text

    return values.map(one, na_action="ignore")


def decode_numeric_bytes(c: Column | str) -> Column:
    """Text that is a list of byte values, one per line, back to the text it stands for.

    Only texts that start with such a line go to Python; all others pass through as they are. ``c`` is read several times: give a costly one as a column.
    """
    raw = col(c)
    listed = raw.rlike(f"^[{SPACE}]*\\d{{1,3}}[{SPACE}]*(?:[\r\n]|$)")
    return F.when(listed, _from_byte_lines(F.when(listed, raw))).otherwise(raw)


def unit_before_year(c: Column | str) -> Column:
    return collapse(pick(collapse(c), r"^(.*?)20\d{2}"))


def string_bool(c: Column) -> Column:
    """False → "false", true → "True", missing → ""."""
    return F.when(c == F.lit(False), "false").when(c, "True").otherwise("")


def safe_label(title: Column, owner: Column) -> Column:
    """Title without the leading owner name and separators."""
    cut = let(collapse(title), lambda text: F.when(
        (owner != "") & F.startswith(text, owner), strip(F.substring(text, F.length(owner) + 1, F.length(text)))).otherwise(text))
    return F.regexp_replace(cut, f"^[{SPACE}|/·、,-]+", "")


def safe_key(c: Column | str) -> Column:
    """Characters that do not fit a record key become underscores."""
    return F.regexp_replace(collapse(c), f"[^0-9A-Za-z_{CJK}-]+", "_")
