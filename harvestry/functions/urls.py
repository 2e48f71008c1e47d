"""URL columns."""

from __future__ import annotations

import mimetypes
from collections.abc import Mapping, Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from harvestry.functions.text import col, collapse, first_non_empty, let, mapped, pick

URL_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


@F.pandas_udf(StringType())
def _join(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b, h):
        if h is None:
            return None
        try:
            return urljoin(b or "", h)
        except ValueError:
            return h
    return pd.Series([one(b, h) for b, h in zip(base, href)])


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """RFC join. Absolute links and plain root-relative paths never leave the JVM."""
    b, h = col(base), collapse(href)
    origin = F.regexp_extract(b, r"^(https?://[^/?#]+)", 1)
    rooted = h.rlike(r"^/[^/]") & ~h.rlike(r"/\.{1,2}(?:/|$|[?#])") & (origin != "")
    is_full = h.rlike(r"^https?://[^/?#]+(?:[/?#]|$)") & ~h.rlike(r"/\.{1,2}(?:/|$|[?#])")
    hard = ~(rooted | is_full)
    joined = _join(F.when(hard, b), F.when(hard, h))
    return F.when(col(href).isNull(), None).when(is_full, h).when(rooted, F.concat(origin, h)).otherwise(joined)


def url_path(c: Column | str) -> Column:
    return pick(c, URL_PATH)


def url_host(c: Column | str) -> Column:
    return pick(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)")


def url_param(c: Column | str, name: str) -> Column:
    return pick(c, rf"[?&]\Q{name}\E=([^&#]*)")


def first_param(c: Column | str, names: Sequence[str]) -> Column:
    return first_non_empty(*[url_param(c, n) for n in names])


def url_id(c: Column | str, pattern: str) -> Column:
    return pick(c, pattern)


def url_path_matches(c: Column | str, pattern: str) -> Column:
    """The pattern looks at the path only, never at host or query."""
    return url_path(c).rlike(pattern)


def asset_url(c: Column | str, base: str, default_marker: str) -> Column:
    """'' for blank or the default picture, absolute otherwise."""
    rooted = lambda raw: F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(raw, "^/+", ""))
    return let(collapse(c), lambda raw: F.when((raw == "") | raw.contains(default_marker), "")
               .when(raw.rlike("^https?://"), raw).otherwise(rooted(raw)))


def prefix_category(c: Column | str, table: Mapping[str, str], sep: str = "_") -> Column:
    """What stands before the separator decides the category; '' when unknown."""
    return mapped(F.substring_index(col(c), sep, 1), table, F.lit(""))


def page_url(base: Column | str, number: Column, style: str = "/page{}/") -> Column:
    """Address of one page; page 1 has no suffix."""
    stem = F.regexp_replace(col(base), "/+$", "")
    head, tail = style.split("{}")
    suffix = F.concat(F.lit(head), number.cast("string"), F.lit(tail))
    first = F.concat(stem, F.lit("/")) if tail.endswith("/") else F.concat(stem, F.lit(tail))
    return F.when(number <= 1, first).otherwise(F.concat(stem, suffix))


def page_count(total: Column, size: int) -> Column:
    """Pages needed for ``total`` rows, at least one."""
    return F.greatest(F.ceil(F.coalesce(total, F.lit(0)) / F.lit(size)), F.lit(1)).cast("bigint")


def page_count_from_text(c: Column | str, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(col(c), pattern, 1).try_cast("bigint"), F.lit(1).cast("bigint"))


def site_url(c: Column | str) -> Column:
    """http scheme and a trailing slash; '' stays ''."""
    return let(F.regexp_replace(collapse(c), "(?i)^https://", "http://"),
               lambda url: F.when((url == "") | url.endswith("/"), url).otherwise(F.concat(url, F.lit("/"))))


def object_key(record_id: Column, url: Column, mime: Column, prefix: str) -> Column:
    """``prefix/id.ext``: extension of the URL path, else of the MIME type, else .jpg."""
    # Leading dots of a file name are part of the name, not an extension.
    ext = F.lower(pick(url_path(url), r"(?:^|/)\.*[^./][^/]*?(\.[^./]*)$"))
    kinds = {m: e for m in ("image/jpeg", "image/png", "image/gif", "image/webp", "image/bmp", "text/html")
             if (e := mimetypes.guess_extension(m))}
    kind = F.lower(F.trim(F.substring_index(F.coalesce(mime, F.lit("")), ";", 1)))
    by_mime = mapped(kind, kinds, F.lit(".jpg"))
    name = F.concat(record_id.cast("string"), F.coalesce(F.nullif(ext, F.lit("")), by_mime))
    clean = prefix.strip().strip("/")
    return F.concat(F.lit(clean + "/"), name) if clean else name


def canonical_request(url: Column, method: Column | None = None, meta: Column | None = None) -> Column:
    """Compact JSON request; absent parts are left out."""
    parts = [url.alias("url")]
    if method is not None:
        parts.append(F.upper(F.when(method != "", method)).alias("method"))
    if meta is not None:
        parts.append(meta.alias("meta"))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def _decoded(c: Column) -> Column:
    """Form-decoded text; broken escapes stay as they are."""
    return F.coalesce(F.try_url_decode(c), F.translate(c, "+", " "))


def _encoded(c: Column) -> Column:
    """Form encoding in which ``~`` stays and ``*`` is escaped."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def set_query_param(c: Column | str, values: Mapping[str, Column]) -> Column:
    """Add or replace query parameters, keep the others in place; of repeated ones the last value counts. Blank values change nothing."""
    url = col(c)
    field = lambda x: F.struct(_decoded(F.substring_index(x, "=", 1)).alias("k"), _decoded(pick(x, r"(?s)^[^=]*=(.*)$", 1)).alias("v"))
    old = F.transform(F.filter(F.split(pick(url, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != ""), field)
    new = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(collapse(v), F.lit("")).alias("v")) for k, v in values.items()]), lambda e: e["v"] != "")
    last = lambda entries, key: F.element_at(F.filter(entries, lambda e: e["k"] == key), -1)["v"]
    query = let(F.concat(old, new), lambda e: F.array_join(F.transform(F.array_distinct(F.transform(e, lambda x: x["k"])), lambda k: F.concat(_encoded(k), F.lit("="), _encoded(last(e, k)))), "&"))
    scheme, base, fragment = pick(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?", 1), pick(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?([^?#]*)", 1), pick(url, r"(?s)#(.+)$", 1)
    marked = lambda mark, part: F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")
    return F.when(url.isNotNull(), F.concat(F.lower(scheme), base, let(query, lambda q: marked("?", q)), marked("#", fragment)))
