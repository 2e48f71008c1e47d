"""Page tables in, rows out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions import markup as mk
from harvestry.functions.dates import find_date
from harvestry.functions.text import bracket_pair, collapse, first_non_empty, let, pick, strip_tags
from harvestry.functions.urls import absolute_url, first_param, url_path


def extract_links(pages: DataFrame, key: str, url: str = "url", html: str = "html", prefix: Column | None = None) -> DataFrame:
    """(page, pos, link): absolute links, first occurrence per page. No shuffle: repeats go inside the page's own array."""
    # The found links are a column of their own: used several times, scanned for once.
    found = pages.withColumns({"_hrefs": mk.hrefs(html), "_prefix": F.lit(None).cast("string") if prefix is None else prefix})
    links = mk.page_links("_hrefs", F.col(url), None if prefix is None else F.col("_prefix"))
    return found.select(key, F.posexplode(links).alias("pos", "link"))


def route_links(links: DataFrame, rules: Mapping[str, str], link: str = "link") -> DataFrame:
    """Next stage per link, by the first path pattern that fits; links of no stage are dropped."""
    chain = F.when(F.lit(False), "")
    path = url_path(link)
    for stage, pattern in rules.items():
        chain = chain.when(path.rlike(pattern), stage)
    return links.withColumn("stage", chain).filter(F.col("stage").isNotNull())


def extract_attachments(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    found = pages.withColumn("_files", mk.file_anchors(html))
    return found.select(key, F.posexplode(mk.attachments("_files", F.col(url))).alias("pos", "file")).select(key, "pos", "file.*")


def extract_tables(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(page, table, row, cells): every table's non-blank rows."""
    found = mk.parse_tables(pages.select(key, html), html, "_tables")
    # Outer, since an inner one adds a filter that reads and cleans the tables once more; what it adds are rows without a place.
    row = lambda r, j, i: F.struct(i.alias("table_no"), j.alias("row_no"), r.alias("cells"))
    rows = F.flatten(F.transform("_tables", lambda t, i: F.transform(mk.clean_rows(t), lambda r, j: row(r, j, i))))
    return found.select(key, F.explode_outer(rows).alias("_row")).filter("_row is not null").select(key, "_row.*")


def list_cards(pages: DataFrame, key: str, url: str = "url", html: str = "html", id_params: Sequence[str] = ("iid", "pid", "proCode", "code"),
               item: str = r"(?is)<li>(.*?)</li>") -> DataFrame:
    """List items with id, title, date, place, method and url; items without title or url skipped, first of each url kept."""
    def card(x: Column) -> Column:
        tag = F.regexp_extract(x, r"(?is)(<a\b[^>]*>)", 1)
        text = strip_tags(F.regexp_extract(x, r"(?is)<a\b[^>]*>(.*?)</a>", 1), " ", entities=False)
        href = collapse(F.regexp_extract(x, r"""(?is)<a[^>]*href=['"]?([^'"\s>]+)""", 1))
        place = collapse(pick(x, r"""(?is)class=['"](?:span1|dq)['"][^>]*>\s*\[?(.*?)\]?\s*</span>"""))
        region, method = bracket_pair(strip_tags(x, " ", entities=False))
        return F.struct(href.alias("href"), first_non_empty(mk.attr(tag, "title"), text).alias("title"), find_date(x).alias("date"),
                        first_non_empty(place, region).alias("place"), method.alias("method"))

    items = F.transform(F.regexp_extract_all(F.col(html), F.lit(item), 1), card)
    found = pages.withColumn("_cards", F.filter(items, lambda c: (c.href != "") & (c.title != "")))
    sound = F.col("_cards")
    links = mk.absolute_links(F.col(url), F.transform(sound, lambda c: c.href))
    both = let(F.struct(sound.alias("c"), links.alias("u")), lambda r: F.filter(
        F.transform(r.c, lambda c, i: F.struct(F.get(r.u, i).alias("link"), c.title.alias("title"), c.date.alias("date"), c.place.alias("place"), c.method.alias("method"))),
        lambda x, i: F.array_position(r.u, x.link) == i + 1))
    rows = found.select(key, F.posexplode(both).alias("pos", "card")).select(key, "pos", "card.*")
    return rows.withColumn("card_id", first_param("link", id_params))


def leaf_links(pages: DataFrame, key: str, block: str, link_pattern: str, url: str = "url", html: str = "html") -> DataFrame:
    """Leaf links of navigation blocks: a block's first link is its parent and dropped when others follow."""
    blocks = F.regexp_extract_all(F.col(html), F.lit(block), 1)
    raw = F.transform(blocks, lambda b: F.array_distinct(F.regexp_extract_all(b, F.lit(link_pattern), 1)))
    leaves = F.flatten(F.transform(raw, lambda x: F.when(F.size(x) > 1, F.slice(x, 2, F.size(x))).otherwise(x)))
    found = pages.withColumn("_leaves", leaves)
    links = F.array_distinct(mk.absolute_links(F.col(url), F.col("_leaves")))
    return found.select(key, F.posexplode(links).alias("pos", "link"))


def leaf_area_links(links: DataFrame, pattern: str, link: str = "link") -> DataFrame:
    """District links only: six-digit area codes that do not end in 00."""
    code = F.regexp_extract(url_path(link), pattern, 1)
    return links.withColumn("area_code", code).filter((F.length(code) == 6) & ~code.endswith("00"))


def discover_tasks(pages: DataFrame, key: str, config: DataFrame, html: str = "html", all_words: Sequence[str] = ("全部", "不限")) -> DataFrame:
    """Navigation links met with a config table (href, module, type) → task rows; nameless and "all" entries dropped.

    The join is left to the optimizer: a small config is broadcast, a large one is shuffled on href.
    """
    links = pages.select(key, F.posexplode(mk.anchors(F.col(html))).alias("pos", "a")).select(key, "pos", F.col("a.href").alias("href"), F.col("a.text").alias("notice_type"))
    named = links.filter((F.col("notice_type") != "") & ~F.col("notice_type").isin(*all_words))
    return named.join(config, "href")


def expand_options(tasks: DataFrame, html: Column, select_id: str, keep: Sequence[str], all_word: str = "不限") -> DataFrame:
    """One task per option of a select: value and sub-type carried, blank and "all" options dropped."""
    block = pick(html, rf"""(?is)<select[^>]*id=["']\Q{select_id}\E["'][^>]*>(.*?)</select>""")
    options = F.transform(F.regexp_extract_all(block, F.lit(r"(?is)<option[^>]*>.*?</option>"), 0),
                          lambda o: F.struct(mk.attr(o, "value").alias("value"), strip_tags(o, " ", entities=False).alias("sub_type")))
    sound = F.filter(options, lambda o: (o.value != "") & (o.sub_type != "") & (o.sub_type != all_word))
    return tasks.select(*keep, F.explode(sound).alias("o")).select(*keep, "o.value", "o.sub_type")


def pick_image(pages: DataFrame, key: str, name: Column, marker: Column, skip: Sequence[str], url: str = "url", html: str = "html") -> DataFrame:
    """(page, image): the chosen picture's absolute address, '' when there is none."""
    chosen = pages.withColumn("_src", mk.image_source(html, name, marker, skip))
    return chosen.select(key, F.coalesce(absolute_url(url, "_src"), F.lit("")).alias("image"))
