"""HTML columns. Patterns run in the JVM; only tables with nested or unclosed parts go through one small Arrow-batched parser."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from harvestry.functions.cleaning import clean_page
from harvestry.functions.text import OTHER_ENTITY, any_contains, basic_entities, canonical_label, col, collapse, join_lines, let, may_hold_entities, one_of, pick, strip, strip_tags
from harvestry.functions.urls import url_path
from harvestry.specs import words

HREF = r"""(?i)href\s*=\s*["']([^"']+)["']"""
ANCHOR = r"""(?is)<a\b[^>]*href\s*=\s*['"][^'"]+['"][^>]*>.*?</a>"""
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
TABLES = ArrayType(ArrayType(ArrayType(StringType())))
PARTS = ArrayType(StructType([StructField("after", BooleanType()), StructField("text", StringType())]))


class _Grid(HTMLParser):
    """Table cells, and the text pieces around the tables. A nested cell counts for every table, row and cell around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open, self.chunks, self.seen = [], [], [], False
        self.count = Counter()  # open elements by tag

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        frame = {"tag": tag, "data": []}
        if tag == "table":
            self.seen = True
            self.tables.append(frame["data"])
            for outer in self.open:
                outer["holds"] = True
        kind = {"tr": "table", "td": "tr", "th": "tr"}.get(tag)
        if kind and self.count[kind]:
            for outer in self.open:
                if outer["tag"] == kind:
                    outer["data"].append(frame["data"])
        self.count[tag] += 1
        self.open.append(frame)

    def handle_endtag(self, tag):
        if self.count[tag]:
            closed = None
            while closed != tag:
                closed = self.open.pop()["tag"]
                self.count[closed] -= 1

    def handle_data(self, data):
        text = data.strip()
        count = self.count
        if not text or count["script"] or count["style"]:
            return
        if count["td"] or count["th"]:
            for frame in self.open:
                if frame["tag"] in ("td", "th"):
                    frame["data"].append(text)
        if not count["table"]:
            self.chunks.append((self.seen, self.open[1:], text))

    def result(self):
        flat = [[[" ".join(c for c in cell if isinstance(c, str)) for cell in row] for row in table] for table in self.tables]
        return {"tables": flat, "parts": _pieces(self.chunks)}


def _pieces(chunks: list) -> list[tuple[bool, str]]:
    """Texts with whether they stand after a table. A piece is the outermost element under the root that holds no table, or a bare string."""
    parts, last = [], None
    for after, path, text in chunks:
        owner = next((f for f in path if "holds" not in f), None)
        if owner is not None and owner is last:
            parts[-1] = (parts[-1][0], f"{parts[-1][1]}\n{text}")
        else:
            parts.append((after, text))
        last = owner
    return parts


#: A tag with quoted attributes, a script or style without tags or comments, or text. The parser library reads pages of nothing else the same way, only slower.
PLAIN_TOKEN = re.compile(r"""<(script|style)>[^<]*</\1>|</([A-Za-z][A-Za-z0-9]*)[ \t\r\n]*>|<([A-Za-z][A-Za-z0-9]*)(?:[ \t\r\n]+[A-Za-z][\w:-]*(?:=(?:"[^"<>]*"|'[^'<>]*'))?)*[ \t\r\n]*(/?)>|([^<]+)""", re.A)
#: Elements whose content is not read as tags; scripts and styles in other forms than the above.
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext svg math".split())


def _fed(parser: _Grid, page: str) -> bool:
    """Feed a page that consists of ``PLAIN_TOKEN`` alone; False, perhaps after some of it, when it holds anything else."""
    at = 0
    for m in PLAIN_TOKEN.finditer(page):
        if m.start() != at:
            return False
        at = m.end()
        raw, closed, opened, alone, text = m.groups()
        if text:
            parser.handle_data(unescape(text) if "&" in text else text)
        elif opened:
            opened = opened.lower()
            if opened in RAW_TAGS:
                return False
            parser.handle_starttag(opened, None)
            if alone:
                parser.handle_endtag(opened)
        elif closed:
            parser.handle_endtag(closed.lower())
    return at == len(page)


_TAG = re.compile(r"""/([A-Za-z][A-Za-z0-9]*)[ \t\r\n]*|([A-Za-z][A-Za-z0-9]*)(?:[ \t\r\n]+[A-Za-z][\w:-]*(?:=(?:"[^"<>]*"|'[^'<>]*'))?)*[ \t\r\n]*(/?)""", re.A)


@lru_cache(maxsize=1 << 14)
def _tag(source: str) -> tuple[str, bool | None, bool] | None:
    """Name of a tag of ``PLAIN_TOKEN``, whether it opens and whether it closes; for a script or style its end tag and None; None for anything else."""
    if source in ("script", "style"):
        return f"/{source}", None, False
    m = _TAG.fullmatch(source)
    if m is None:
        return None
    closed, opened, alone = m.groups()
    name = (opened or closed).lower()
    if opened and name in RAW_TAGS:
        return None
    return name, bool(opened) and name not in VOID_TAGS, bool(closed or alone)


def _plain_parts(page: str) -> list[tuple[bool, str]] | None:
    """The parts that ``_Grid`` finds on a page of ``PLAIN_TOKEN`` alone, without reading its cells; None for other pages."""
    open_, chunks, count, seen, end = [], [], defaultdict(int), False, ""
    text, *pieces = page.split("<")
    if text := unescape(text).strip():
        chunks.append((False, (), text))
    for piece in pieces:
        source, closed, text = piece.partition(">")
        if end:
            if not closed or source != end:
                return None
            end = ""
        elif not closed or (tag := _tag(source)) is None:
            return None
        else:
            name, opens, closes = tag
            if opens:
                if name == "table":
                    seen = True
                    for outer in open_:
                        outer["holds"] = True
                count[name] += 1
                open_.append({"tag": name})
            elif opens is None:
                end = name
                continue
            if closes and count[name]:
                last = None
                while last != name:
                    last = open_.pop()["tag"]
                    count[last] -= 1
        if text and not count["table"] and (text := unescape(text).strip()):
            chunks.append((seen, open_[1:], text))
    return None if end else _pieces(chunks)


def _parsed(html: str, what: str):
    if what == "parts" and (parts := _plain_parts(html)) is not None:
        return parts
    parser = _Grid()
    if not _fed(parser, html):
        parser = _Grid()
        parser.feed(html)
        parser.close()
    return parser.result()[what]


@F.pandas_udf(TABLES)
def _tables(values: pd.Series) -> pd.Series:
    return values.map(lambda html: _parsed(html, "tables"), na_action="ignore")


@F.arrow_udf(PARTS)
def _parts(values: pa.Array) -> pa.Array:
    starts, after, texts = [], [], []
    for html in values.to_pylist():
        starts.append(None if html is None else len(texts))  # no start: a null
        for place, text in () if html is None else _parsed(html, "parts"):
            after.append(place)
            texts.append(text)
    pieces = pa.StructArray.from_arrays([pa.array(after, pa.bool_()), pa.array(texts, pa.string())], ["after", "text"])
    return pa.ListArray.from_arrays(pa.array([*starts, len(texts)], pa.int32()), pieces)


def _opening(selector: str) -> str:
    """Pattern of the start tag a selector means; group 1 is the tag name."""
    name = re.escape(selector[1:])
    if selector[0] == ".":
        return rf"""(?is)<(\w+)\b[^>]*\sclass\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?')[^>]*>"""
    if selector[0] == "#":
        return rf"""(?is)<(\w+)\b[^>]*\sid\s*=\s*["']{name}["'][^>]*>"""
    return rf"(?is)<({re.escape(selector)})\b[^>]*>"


def _balanced(page: Column, selector: str) -> Column:
    """The element from its start tag to the matching end tag, by counting its own tag; null when absent."""
    # Most pages without the name need no search for its tag; the tag's name is read off the tag found.
    named = lambda p: p.contains(selector.lstrip(".#")) | p.rlike("(?i)" + re.escape(selector.lstrip(".#")))
    head = let(page, lambda p: F.when(named(p), F.struct(p.alias("page"), F.regexp_extract(p, _opening(selector), 0).alias("head"))))
    start = let(head, lambda r: F.when(r["head"] != "", F.struct(r["page"].alias("page"), r["head"].alias("head"), F.regexp_extract(r["head"], _opening(selector), 1).alias("tag"))))

    def cut(r: Column) -> Column:
        rest = F.substring(r["page"], F.call_function("locate", r["head"], r["page"]), F.length(r["page"]))
        return let(F.call_function("split", rest, F.concat(F.lit("(?i)(?=</?"), r["tag"], F.lit("\\b)"))), until_closed)

    def until_closed(pieces: Column) -> Column:
        closes = lambda x: x.startswith("</")
        none = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("stop"))

        def step(acc: Column, x: Column) -> Column:
            depth = acc["depth"] + F.when(closes(x), -1).otherwise(1)
            seen = acc["seen"] + 1
            return F.struct(depth.alias("depth"), seen.alias("seen"), F.when((acc["stop"] == 0) & (depth == 0), seen).otherwise(acc["stop"]).alias("stop"))

        stop = F.aggregate(pieces, none, step)["stop"]
        return let(stop, lambda n: F.when(n > 0, F.concat(F.array_join(F.slice(pieces, 1, n - 1), ""), F.regexp_extract(F.get(pieces, n - 1), "^[^>]*>", 0)))
                   .otherwise(F.array_join(pieces, "")))

    return let(start, lambda r: F.when(r.isNotNull(), cut(r)))


MASK = "\ue000"
HIDDEN = r"(?is)<(?:!--.*?-->|(?:script|style)\b.*?</(?:script|style)\s*>)"


def _masked(page: Column, always: bool = False) -> Column:
    """Page with the ``<`` of comments, scripts and styles swapped for a private character, so their text cannot pass for tags.

    Where all are scripts and styles without attributes, and without a ``<`` in their text, nothing in them can: such pages stay as they are.
    """
    def swap(p: Column) -> Column:
        shown, hidden = F.split(p, HIDDEN), F.regexp_extract_all(p, F.lit(HIDDEN), 0)
        return F.array_join(F.zip_with(shown, hidden, lambda a, b: F.concat(a, F.coalesce(F.replace(b, F.lit("<"), F.lit(MASK)), F.lit("")))), "")

    marks = r"(?i)<(?:!--|script|style)" if always else r"(?i)<(?:!--|(?:script|style)\b(?!>[^<]*</(?:script|style)\s*>))"
    return let(page, lambda p: F.when(p.rlike(marks), swap(p)).otherwise(p))


def first_block(html: Column | str, selectors: Sequence[str]) -> Column:
    """Source of the first element that fits the first fitting selector (``tag``, ``.class``, ``#id``); the whole page when none does."""
    page = col(html)
    hidden = _masked(page) if not {s.lower() for s in selectors} & {"script", "style"} else _masked(page, always=True)
    found = let(hidden, lambda p: F.coalesce(*[_balanced(p, s) for s in selectors]))
    return F.coalesce(let(found, lambda b: F.when(b.contains(MASK), F.replace(b, F.lit(MASK), F.lit("<"))).otherwise(b)), page)


def unwrap_nested_document(html: Column | str, shell_marks: Sequence[str] = ("链接地址", "gtqrlj", 'class="table2"', "class='table2'"),
                           placeholder: str = r"(?i)\$\(\s*0\s*,\s*#ca(?:data|id)\d+\s*\)") -> Column:
    """The inner document of a page that wraps a second one, when the shell looks like a known wrapper."""
    page = col(html)
    nested = F.regexp_count(page, F.lit(r"(?i)<html\b")) > 1

    def unwrap(p: Column) -> Column:
        inner = F.regexp_extract(p, r"(?is)<html\b.*?(<html\b.*</html>)", 1)
        shell = F.regexp_extract(p, r"(?is)^(.*?<html\b.*?)<html\b", 1)
        wrapper = shell.rlike(one_of(shell_marks)) | p.rlike(r"(?i)\$\(\s*0\s*,\s*#cadata\d+\s*\)")
        return F.when((inner != "") & wrapper, F.regexp_replace(inner, placeholder, "")).otherwise(p)

    return F.when(nested, let(page, unwrap)).otherwise(page)


# --- links -------------------------------------------------------------------
@F.pandas_udf(ArrayType(StringType()))
def _join_all(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    def one(b, links):
        if links is None:
            return None
        out = []
        for link in links:
            try:
                out.append(urljoin(b or "", link))
            except ValueError:
                out.append(link)
        return out
    return pd.Series([one(b, h) for b, h in zip(base, hrefs)], dtype=object)


def absolute_links(base: Column | str, hrefs: Column) -> Column:
    """All links of a page absolute, in order. Pages with only full or root-relative links stay in the JVM."""
    b = col(base)
    origin = F.regexp_extract(b, r"^(https?://[^/?#]+)", 1)
    simple = r"^(?:/[^/]|https?://[^/?#]+(?:[/?#]|$)|/$)"
    dotted = r"/\.{1,2}(?:/|$|[?#])"
    hard = (origin == "") | F.exists(hrefs, lambda h: ~h.rlike(simple) | h.rlike(dotted))
    easy = let(F.struct(origin.alias("o"), hrefs.alias("h")), lambda r: F.transform(r.h, lambda h: F.when(h.startswith("/"), F.concat(r.o, h)).otherwise(h)))
    return F.coalesce(_join_all(b, F.when(hard, hrefs)), easy)


def hrefs(html: Column | str) -> Column:
    """Link targets as written, repeats removed, order kept."""
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(col(html), F.lit(HREF), 1), collapse), lambda h: h != ""))


def page_links(found: Column | str, base: Column | str, prefix: Column | None = None) -> Column:
    """Absolute links of a page's ``hrefs``, first occurrences in order, optionally only those under a prefix."""
    links = F.array_distinct(absolute_links(base, col(found)))
    return links if prefix is None else F.filter(links, lambda x: F.startswith(x, prefix))


def attr(tag: Column, name: str) -> Column:
    """Attribute of one tag's source, '' when missing."""
    return collapse(F.regexp_extract(tag, rf"""(?is)^<[^>]*?\s{name}\s*=\s*['"]([^'"]*)['"]""", 1))


def anchors(html: Column | str) -> Column:
    """Anchors in order: href, title and text."""
    read = lambda a: F.struct(attr(a, "href").alias("href"), attr(a, "title").alias("title"), strip_tags(a, entities=False).alias("text"))
    return F.transform(F.regexp_extract_all(col(html), F.lit(ANCHOR), 0), read)


FILE_LINK = r"(?i)\.(pdf|doc|docx|xls|xlsx|zip|rar|7z)(?:$|[?#])"
FILE_API = r"(?i)(?:ztbpdfbybidguid|downloadfile|download\.do|attach|file)"
MANUALS = r"(?i)(?:操作手册|操作说明|供应商下载采购文件)"


def file_anchors(html: Column | str, file_link: str = FILE_LINK, file_api: str = FILE_API, manuals: str = MANUALS) -> Column:
    """Anchors that lead to a file, manuals left out. Only theirs are read for title and text."""
    targets = F.transform(F.regexp_extract_all(col(html), F.lit(ANCHOR), 0), lambda a: F.struct(attr(a, "href").alias("href"), a.alias("tag")))
    files = F.filter(targets, lambda a: (a.href != "") & (a.href.rlike(file_link) | a.href.rlike(file_api)))
    read = F.transform(files, lambda a: F.struct(a.href.alias("href"), attr(a.tag, "title").alias("title"), strip_tags(a.tag, entities=False).alias("text")))
    return F.filter(read, lambda a: ~F.concat(a.href, a.text).rlike(manuals))


def attachments(files: Column | str, base: Column | str) -> Column:
    """A page's ``file_anchors`` as url, type and name; the first of each url is kept."""
    files = col(files)
    urls = absolute_links(base, F.transform(files, lambda a: a.href))

    def build(r: Column) -> Column:
        def one(u: Column, i: Column) -> Column:
            last = pick(url_path(u), r"([^/]*)$")
            name = F.coalesce(F.nullif(F.get(r.f, i).text, F.lit("")), last)
            kind = F.lower(pick(last, r"[^.]\.([^.]*)$"))
            return F.struct(u.alias("fileUrl"), F.coalesce(F.nullif(kind, F.lit("")), F.lower(pick(name, r"[^.]\.([^.]*)$"))).alias("fileType"), name.alias("fileName"))
        return F.filter(F.transform(r.u, one), lambda x, i: F.array_position(r.u, x.fileUrl) == i + 1)

    return let(F.struct(files.alias("f"), urls.alias("u")), build)


# --- text blocks ---------------------------------------------------------------
def extract_title(html: Column | str, classes: Sequence[str] = ("title_p", "tle"), entities: bool = True) -> Column:
    """Site title node, h1 or h2, ``<title>`` after its first dash; without a ``<title>`` the value of the first labelled item, if its label names a notice."""
    from harvestry.functions.text import norm_text

    plain = lambda c: let(strip_tags(c, " ", entities=False), lambda x: F.when(x != "", x))
    named = lambda text, c: text.contains(c) & text.rlike(rf"""(?i)class=["'][^"']*\b{c}\b""")
    node = lambda text, c: F.when(named(text, c), plain(pick(text, rf"""(?is)<(\w+)[^>]*class=["'][^"']*\b{c}\b[^"']*["'][^>]*>(.*?)</\1>""", 2)))
    after_dash = lambda x: F.when(x.contains("-"), pick(x, "(?s)^[^-]*-(.*)$")).otherwise(x)
    title = rf"""class=["'][^"']*\b{words.ITEM_TITLE}\b[^"']*["'][^>]*>"""
    label = lambda text: F.rtrim(collapse(pick(text, rf"(?is){title}\s*(?:<[^>]*>\s*)*([^<]*)")), F.lit("：: "))
    value = rf"""(?is){title}.*?<(\w+)\b[^>]*class=["'][^"']*\b{words.ITEM_VALUE}\b[^"']*["'][^>]*>(.*?)</\1>"""
    hit = let(col(html), lambda text: F.coalesce(
        *[node(text, c) for c in classes], plain(pick(text, r"(?is)<(h[12])\b[^>]*>(.*?)</\1>", 2)),
        F.when(text.rlike(r"(?i)<title\b"), let(strip_tags(pick(text, r"(?is)<title\b[^>]*>(.*?)</title>"), entities=False), lambda x: collapse(after_dash(x)))),
        F.when(text.contains(words.ITEM_BOX) & label(text).isin(*words.ITEM_LABELS), plain(pick(text, value, 2))),
        F.lit("")))
    return norm_text(hit, suspect=may_hold_entities(html)) if entities else hit


def plain_lines(html: Column | str, entities: bool = True) -> Column:
    """Text of a fragment, one line per text node."""
    bare = F.regexp_replace(col(html), r"(?is)<(?:(script|style)\b.*?</\1\s*>|!--.*?-->)", "")
    return join_lines(F.regexp_replace(bare, r"(?:<[^>]+>[ \n]*+)++", "\n"), entities=entities, suspect=may_hold_entities(html))


#: What a page shows that has nodes to remove or to bring to light; others only lose scripts and anchor tags.
CLEAN_TRACES = tuple(dict.fromkeys(x.lower() for x in (
    words.NOISE_BREADCRUMB, words.GREETING, *words.NOISE_EXACT_TEXTS, *words.NOISE_PREFIXES, words.NOISE_HELP_PATH, words.NOISE_LOGIN_PATH, *words.BUTTON_VALUES, words.CLOSING_TEXT,
    words.CHANGES_TEXT, words.POPUP_FRAME_ID, *words.FILE_MARKS, words.FILE_TEXT, "display", "visibility", "hidden", "hide")))
SCRIPTS = r"(?is)<(script|style)\b.*?</\1\s*>|<link\b[^>]*>"


@F.pandas_udf(StringType())
def _cleaned(pages: pd.Series) -> pd.Series:
    return pages.map(clean_page, na_action="ignore")


def clean_html(html: Column | str) -> Column:
    """Scripts out, attachment anchors and furniture out as whole nodes, other anchors unwrapped, hidden content shown.

    Pages without a trace of what the node rules look for stay in the JVM.
    """
    bare = let(unwrap_nested_document(html), lambda p: F.regexp_replace(p, SCRIPTS, ""))
    traced = let(F.lower(bare), lambda low: any_contains(low, CLEAN_TRACES))
    return F.coalesce(_cleaned(F.when(traced, bare)), strip(F.regexp_replace(bare, r"(?is)</?a\b[^>]*>", "")))


# --- tables --------------------------------------------------------------------
#: A table of whole rows of whole cells, whose other tags are neither parts of tables nor scripts. Possessive, so that long tables need no stack.
FLAT_TABLE = (r"(?i)^<table\b[^<>]*+>(?:[^<]|</?(?:tbody|thead|tfoot)>)*+(?:<tr\b[^<>]*+>[^<]*+(?:<t[dh]\b[^<>]*+>(?:[^<]|<(?!/?t(?:[rdh]|able)\b|!--|script))*+</t[dh]\s*+>[^<]*+)*+</tr\s*+>"
              r"(?:[^<]|</?(?:tbody|thead|tfoot)>)*+)*+</table\s*+>$")


def flat_tables(html: Column | str) -> Column:
    """Every table as rows of cell texts, read by pattern; null when a table is nested, unclosed or holds rare entities."""
    same = lambda t, a, b: F.regexp_count(t, F.lit(a)) == F.regexp_count(t, F.lit(b))
    counted = lambda t: ((F.regexp_count(t, F.lit(r"(?i)<table\b")) == 1) & same(t, r"(?i)<tr\b", r"(?i)</tr\b") & same(t, r"(?i)<t[dh]\b", r"(?i)</t[dh]\b")
                         & ~t.rlike("<(?:!--|(?i:script))"))
    closed = lambda t: t.rlike(r"(?i)</table\s*>$")
    # One pass finds most tables flat without the counts.
    flat = lambda t: ~(t.contains("&") & t.rlike(OTHER_ENTITY)) & (t.rlike(FLAT_TABLE) | closed(t) & counted(t))
    bare = lambda c: F.when(c.contains("<"), F.regexp_replace(c, "<[^>]+>", " ")).otherwise(c)
    cell = lambda c: F.when(c.contains("&"), basic_entities(bare(c))).otherwise(bare(c))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), 1), cell)
    rows = lambda t: F.transform(F.regexp_extract_all(t, F.lit(r"(?is)<tr\b.*?</tr\s*>"), 0), cells)

    # An unclosed table is found as its bare beginning, which is not flat.
    found = F.regexp_extract_all(col(html), F.lit(r"(?is)<table\b(?:.*?</table\s*>)?"), 0)
    return let(found, lambda f: F.when(F.forall(f, flat), F.transform(f, rows)))


def parse_tables(df: DataFrame, html: str, name: str = "tables") -> DataFrame:
    """Add every table of the page as rows of cell texts, blank ones included. Only irregular pages go to the parser."""
    empty = F.array().cast("array<array<array<string>>>")
    read = df.withColumn("_flat", flat_tables(html))
    parsed = _tables(F.when(F.col("_flat").isNull(), F.col(html)))
    return read.withColumn(name, F.coalesce("_flat", parsed, empty)).drop("_flat")


def parse_parts(html: Column | str) -> Column:
    """Text pieces before and after the first table; only pages that have a table go to the parser."""
    page = col(html)
    whole = F.array(F.struct(F.lit(False).alias("after"), plain_lines(page, entities=False).alias("text")))
    return F.coalesce(_parts(F.when(page.rlike(r"(?i)<table\b"), page)), F.filter(whole, lambda p: p["text"] != ""))


def clean_rows(table: Column, keep_blank_cells: bool = False) -> Column:
    """Cells normalised; blank cells (unless kept) and blank rows dropped."""
    cells = F.transform(table, lambda row: F.transform(row, collapse))
    if keep_blank_cells:
        return F.filter(cells, lambda row: F.exists(row, lambda c: c != ""))
    return F.filter(F.transform(cells, lambda row: F.filter(row, lambda c: c != "")), lambda row: F.size(row) > 0)


def label_text(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, "（）", "()"), "[：:]+$", "")


def first_wins(entries: Column) -> Column:
    """Entry list to a map; the first entry of a key counts."""
    named = let(entries, lambda e: F.struct(e.alias("e"), F.transform(e, lambda y: y["key"]).alias("keys")))
    return F.map_from_entries(let(named, lambda r: F.filter(r["e"], lambda x, i: F.array_position(r["keys"], x["key"]) == i + 1)))


def last_wins(entries: Column) -> Column:
    return first_wins(F.reverse(entries))


def pair_entries(rows: Column) -> Column:
    """Label/value entries of the rows with an even number of cells."""
    even = F.filter(rows, lambda r: (F.size(r) >= 2) & (F.size(r) % 2 == 0))
    pairs = F.flatten(F.transform(even, lambda r: F.transform(F.sequence(F.lit(0), F.size(r) - 2, F.lit(2)), lambda i: F.struct(
        label_text(F.get(r, i)).alias("key"), F.get(r, i + 1).alias("value")))))
    return F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))


def pairs_from_rows(rows: Column) -> Column:
    return first_wins(pair_entries(rows))


def header_zip(rows: Column, keywords: Sequence[str]) -> Column:
    """Data rows as maps when the header row holds a result word: canonical and raw names to the cell."""
    def zipped(all_rows: Column) -> Column:
        header = F.element_at(all_rows, 1)
        hit = F.exists(header, lambda h: h.rlike(one_of(keywords)))
        data = F.filter(F.slice(all_rows, 2, F.size(all_rows)), lambda r: F.size(r) >= 2)

        def as_map(names: Column, row: Column) -> Column:
            used = F.slice(names, 1, F.least(F.size(names), F.size(row)))
            entry = lambda h, i: F.array(F.struct(h["name"].alias("key"), F.get(row, i).alias("value")), F.struct(h["label"].alias("key"), F.get(row, i).alias("value")))
            return last_wins(F.filter(F.flatten(F.transform(used, entry)), lambda e: e["key"] != ""))

        names = F.transform(header, lambda h: F.struct(canonical_label(h).alias("name"), h.alias("label")))
        return F.when(hit, let(names, lambda n: F.transform(data, lambda row: as_map(n, row)))).otherwise(F.array().cast("array<map<string,string>>"))

    return let(rows, lambda r: F.when(F.size(r) > 0, zipped(r)).otherwise(F.array().cast("array<map<string,string>>")))


def span_entries(html: Column | str, label_class: str = "l_span", value_class: str = "r_span") -> Column:
    """Label/value entries of neighbouring spans."""
    pattern = rf"""(?is)<span[^>]*class="{label_class}"[^>]*>.*?</span>\s*<span[^>]*class="{value_class}"[^>]*>.*?</span>"""
    halves = lambda m: F.struct(label_text(strip_tags(F.regexp_extract(m, r"(?is)^<span[^>]*>(.*?)</span>", 1), entities=False)).alias("key"),
                                strip_tags(F.regexp_extract(m, r"(?is)</span>\s*<span[^>]*>(.*)</span>$", 1), entities=False).alias("value"))
    return F.transform(F.regexp_extract_all(col(html), F.lit(pattern), 0), halves)


LINE_LABELS = ("采购人", "采购单位", "采购单位名称", "招标人", "招标单位", "建设单位", "转让方", "项目编号", "公共资源交易编号", "联系人", "联系电话", "联系方式",
               "中标单位", "中标人", "成交供应商", "中标供应商名称", "供应商名称", "中标金额", "中标金额(元)", "中标价", "成交金额", "成交价", "中标信息")


def line_entries(lines: Column | str, labels: Sequence[str] = LINE_LABELS) -> Column:
    """``label：value`` entries of plain text, one per known label. A plain substring test spares the pattern for absent labels."""
    entry = lambda text, x: F.struct(F.lit(x).alias("key"), F.when(text.contains(x), collapse(pick(text, rf"\Q{x}\E\s*[：:]\s*([^\n]+)"))).alias("value"))
    return let(col(lines), lambda text: F.filter(F.array(*[entry(text, x) for x in labels]), lambda e: e["value"].isNotNull() & (e["value"] != "")))


def field_sources(html: Column | str, rows: Column, lines: Column | str, labels: Sequence[str] = LINE_LABELS) -> Column:
    """Label/value entries of the spans, the tables' ``clean_rows`` and the text lines. Make it a column: field maps of several rules then share it."""
    spans = F.filter(span_entries(html), lambda e: e["key"] != "")
    return F.struct(spans.alias("spans"), F.flatten(F.transform(rows, pair_entries)).alias("pairs"), line_entries(lines, labels).alias("lines"))


def field_map(sources: Column | str, span_rule: str = "last") -> Column:
    """Labels to values: spans (later ones overwrite, or first wins), then table pairs, then text lines; earlier ``field_sources`` win."""
    s = col(sources)
    spans = F.reverse(s["spans"]) if span_rule == "last" else F.filter(s["spans"], lambda e: e["value"] != "")
    return first_wins(F.concat(spans, s["pairs"], s["lines"]))


def table_section(rows: Column, start: Sequence[str], stop: Sequence[str]) -> Column:
    """Cells between a header row (its own values included) and the stop row: label/value entries."""
    def cut(all_rows: Column) -> Column:
        firsts = F.transform(all_rows, lambda r: F.element_at(r, 1))
        holds = lambda c, marks: F.forall(F.array(*[F.lit(m) for m in marks]), lambda m: F.contains(c, m))
        begin = F.array_position(F.transform(firsts, lambda c: holds(c, start)), F.lit(True))
        tail = F.slice(firsts, F.greatest(begin, F.lit(1)).cast("int") + 1, F.size(firsts))
        end = F.array_position(F.transform(tail, lambda c: c.rlike(one_of(stop))), F.lit(True))
        length = F.when(end > 0, end).otherwise(F.size(all_rows)).cast("int")
        section = F.slice(all_rows, F.greatest(begin, F.lit(1)).cast("int"), length)
        cells = F.flatten(F.transform(section, lambda r, i: let(
            F.when(i == 0, F.slice(r, 2, F.size(r))).otherwise(r),
            lambda c: F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.size(c), F.lit(1)) - 1), lambda j: (j % 2 == 0) & (j + 1 < F.size(c))),
                                  lambda j: F.struct(F.get(c, j).alias("key"), F.get(c, j + 1).alias("value"))))))
        return F.when(begin > 0, cells).otherwise(F.array().cast("array<struct<key:string,value:string>>"))

    empty = F.array().cast("array<struct<key:string,value:string>>")
    return let(rows, lambda r: F.when(F.size(r) > 0, cut(r)).otherwise(empty))


def content_mix(tables: Column, parts: Column, title: Column) -> Column:
    """Text before, head and body of the first table, text after. The title is left out, blank body cells stay."""
    def mix(r: Column) -> Column:
        kept = lambda after: F.array_join(F.filter(F.transform(F.filter(r["parts"], lambda p: p["after"] == F.lit(after)), lambda p: join_lines(p["text"], entities=False)),
                                                   lambda x: (x != "") & (x != r["title"])), "\n")
        first = F.try_element_at(r["tables"], F.lit(1))
        body = F.filter(F.slice(first, 2, F.greatest(F.size(first), F.lit(1))), lambda row: F.exists(row, lambda c: c != ""))
        # Without a table the whole text is one piece, and the title is dropped line by line.
        lines = F.array_join(F.filter(F.split(kept(False), "\n"), lambda x: x != r["title"]), "\n")
        return F.struct(F.when(F.size(r["tables"]) > 0, kept(False)).otherwise(lines).alias("before"), F.try_element_at(first, F.lit(1)).alias("head"),
                        F.coalesce(body, F.array().cast("array<array<string>>")).alias("body"), kept(True).alias("after"))

    clean = F.transform(tables, lambda t: F.transform(t, lambda row: F.transform(row, collapse)))
    return let(F.struct(clean.alias("tables"), parts.alias("parts"), title.alias("title")), mix)


# --- script state and pictures ---------------------------------------------------
def script_var(html: Column | str, name: str, default: str = "") -> Column:
    """Value of ``var name = …;``."""
    found = pick(html, rf"""(?i)var\s+\Q{name}\E\s*=\s*['"]?([^'";]+)['"]?\s*;""")
    return F.when(found != "", strip(found)).otherwise(default)


def active_attr(html: Column | str, container: str, attribute: str, default: str = "0") -> Column:
    """Attribute of the anchor marked ``on`` inside a container."""
    found = pick(html, rf"""(?is)id=["']\Q{container}\E["'].*?<a[^>]*class=["'][^"']*\bon\b[^"']*["'][^>]*\Q{attribute}\E=["']([^"']*)["']""")
    return F.when(found != "", strip(found)).otherwise(default)


#: A whole quoted string, a bracket, a separator, or a run of anything else; possessive, so long literals need no stack.
SCRIPT_TOKEN = r"""(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?|'[^'\\]*+(?:\\.[^'\\]*+)*+'?|[(\[{]|[)\]}]|[,;]|[^"'()\[\]{},;]++"""


def split_script(c: Column, separator: str) -> Column:
    """Script text cut at the separators that stand in no string and no bracket."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))

    def step(state: Column, token: Column) -> Column:
        cut = (state["depth"] == 0) & (token == separator)
        depth = state["depth"] + F.when(token.isin("(", "[", "{"), 1).when(token.isin(")", "]", "}"), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(cut, "").otherwise(F.concat(state["open"], token)).alias("open"),
                        F.when(cut, F.concat(state["done"], F.array(strip(state["open"])))).otherwise(state["done"]).alias("done"))

    return F.aggregate(F.regexp_extract_all(c, F.lit(SCRIPT_TOKEN), F.lit(0)), start, step, lambda s: F.concat(s["done"], F.array(strip(s["open"]))))


def script_value(c: Column) -> Column:
    """Struct of the text before the first ``;`` in no string and no bracket, and whether there is one."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("value"), F.lit(False).alias("closed"))

    def step(state: Column, token: Column) -> Column:
        closed = state["closed"] | (state["depth"] == 0) & (token == ";")
        depth = state["depth"] + F.when(token.isin("(", "[", "{"), 1).when(token.isin(")", "]", "}"), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(closed, state["value"]).otherwise(F.concat(state["value"], token)).alias("value"), closed.alias("closed"))

    return F.aggregate(F.regexp_extract_all(c, F.lit(SCRIPT_TOKEN), F.lit(0)), start, step)


def script_aliases(html: Column | str, call: str = r"(?s)window\.[A-Z_]+=\(function\((.*?)\)\{.*?\}\((.*?)\)\);?\s*</script>") -> Column:
    """Parameter names of a wrapping function to the arguments it is called with, place by place."""
    names = F.transform(F.split(pick(html, call, 1), ","), strip)
    values = split_script(pick(html, call, 2), ",")
    return let(F.struct(names.alias("n"), values.alias("v")), lambda r: first_wins(F.filter(
        F.transform(r.n, lambda n, i: F.struct(n.alias("key"), F.get(r.v, i).alias("value"))), lambda e: (e["key"] != "") & e["value"].isNotNull())))


def unquote(c: Column) -> Column:
    plain = F.regexp_replace(c, r"""(?s)^["'](.*)["']$""", "$1")
    plain = F.replace(F.replace(plain, F.lit("\\u002F"), F.lit("/")), F.lit('\\"'), F.lit('"'))
    return F.when(c.isin("null", "void 0", "undefined"), "").otherwise(F.replace(plain, F.lit("\\n"), F.lit("\n")))


def script_assignments(html: Column | str, owner: str, aliases: Column) -> Column:
    """``owner.key=value;`` statements as a map; values end at the ``;`` outside strings and brackets, and what stands inside a value is no
    statement. Bare names are looked up among the aliases, later statements win."""
    head = rf"\b\Q{owner}\E\.(?=\w+\s*=)"
    pieces = F.split(col(html), head, -1)
    none = F.array().cast("array<struct<key:string,raw:string>>")
    start = F.struct(F.lit(None).cast("string").alias("key"), F.lit("").alias("open"), none.alias("done"))

    def step(state: Column, piece: Column) -> Column:
        fresh = state["key"].isNull()
        key = F.when(fresh, F.regexp_extract(piece, r"^(\w+)", 1)).otherwise(state["key"])
        text = F.when(fresh, F.regexp_replace(piece, r"^\w+\s*=", "")).otherwise(F.concat(state["open"], F.lit(owner + "."), piece))
        return let(F.struct(key.alias("key"), text.alias("text"), script_value(text).alias("v")), lambda r: F.struct(
            F.when(~r["v"]["closed"], r["key"]).alias("key"), F.when(~r["v"]["closed"], r["text"]).otherwise("").alias("open"),
            F.when(r["v"]["closed"], F.concat(state["done"], F.array(F.struct(r["key"].alias("key"), strip(r["v"]["value"]).alias("raw"))))).otherwise(state["done"]).alias("done")))

    found = F.aggregate(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), start, step, lambda s: s["done"])

    def build(r: Column) -> Column:
        value = lambda raw: unquote(F.coalesce(F.try_element_at(r.a, raw), raw))
        return last_wins(F.transform(r.f, lambda e: F.struct(e["key"].alias("key"), let(e["raw"], value).alias("value"))))

    return let(F.struct(found.alias("f"), aliases.alias("a")), build)


def image_source(html: Column | str, name: Column, marker: Column, skip: Sequence[str]) -> Column:
    """Source of the picture whose alt is the name, else of the one with the id marker; logos and defaults skipped."""
    tags = F.regexp_extract_all(col(html), F.lit(r"(?is)<img\b[^>]*>"), 0)
    images = F.transform(tags, lambda x: F.struct(attr(x, "src").alias("src"), attr(x, "alt").alias("alt")))

    def choose(r: Column) -> Column:
        sound = F.filter(r["images"], lambda x: (x["src"] != "") & ~F.lower(x["src"]).rlike(one_of(skip)))
        named = F.filter(sound, lambda x: (r["name"] != "") & (x["alt"] == r["name"]))
        marked = F.filter(sound, lambda x: (r["marker"] != "") & F.contains(F.lower(x["src"]), F.lower(r["marker"])))
        return F.coalesce(F.try_element_at(named, F.lit(1))["src"], F.try_element_at(marked, F.lit(1))["src"])

    return let(F.struct(images.alias("images"), name.alias("name"), marker.alias("marker")), choose)


def dataset_assets(html: Column | str) -> Column:
    """extension → token and file name of the download links; the last one of an extension counts."""
    pattern = r'(?is)class="downloadFileLink"\s+id="([^"]+)".*?class="file-name">([^<]+)</span>'

    def one(m: Column) -> Column:
        name = strip(F.regexp_extract(m, pattern, 2))
        return F.struct(F.lower(F.substring_index(name, ".", -1)).alias("key"), F.struct(strip(F.regexp_extract(m, pattern, 1)).alias("token"), name.alias("filename")).alias("value"))

    return last_wins(F.transform(F.regexp_extract_all(col(html), F.lit(pattern), 0), one))


def breadcrumb_next(html: Column | str, container: str, marker: str) -> Column:
    """Crumb right after the marker, '' when there is none."""
    block = pick(html, container)
    crumbs = F.transform(F.regexp_extract_all(block, F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), 1), lambda a: strip_tags(a, " ", entities=False))
    return let(crumbs, lambda c: F.coalesce(F.when(F.array_position(c, F.lit(marker)) > 0, F.get(c, F.array_position(c, F.lit(marker)).cast("int"))), F.lit("")))


def after_heading(html: Column | str, heading: str, phrase: str) -> Column:
    """First paragraph after the heading that holds the phrase."""
    body = pick(html, rf"(?is)<{heading}\b[^>]*>(?:(?!</{heading}>).)*\Q{phrase}\E(?:(?!</{heading}>).)*</{heading}>.*?<p\b[^>]*>(.*?)</p>")
    return join_lines(F.regexp_replace(F.regexp_replace(body, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", ""), entities=False)


def labelled_items(items: Column) -> Column:
    """``<span class="string">label</span> value`` items to a map; the label is cut off the item's text."""
    def one(item: Column) -> Column:
        label = strip_tags(F.regexp_extract(item, r'(?is)<span[^>]*class="string"[^>]*>(.*?)</span>', 1), " ", entities=False)
        text = strip_tags(item, " ", entities=False)
        return F.struct(label.alias("label"), text.alias("text"))

    sound = F.filter(F.transform(items, one), lambda e: (e.label != "") & F.startswith(e.text, e.label))
    return last_wins(F.transform(sound, lambda e: F.struct(F.regexp_replace(e.label, "：+$", "").alias("key"), strip(F.substring(e.text, F.length(e.label) + 1, F.length(e.text))).alias("value"))))
