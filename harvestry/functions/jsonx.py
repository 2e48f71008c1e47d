"""JSON text as VARIANT values: paths, envelopes and lists. Bad JSON is an empty object, never a failed job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.functions.dates import month_text
from harvestry.functions.text import any_contains, col, let, mapped, strip

RECORD_KEYS = ("pageList", "dataList", "items", "list", "doctorList", "data_list")


def parse_payload(c: Column | str) -> Column:
    """JSON object, or an empty object when the text is malformed."""
    return F.coalesce(F.try_parse_json(col(c)), F.parse_json(F.lit("{}")))


def _paths(path: str) -> list[str]:
    """A digit segment may be an object key or a list position: one path per reading."""
    options = []
    for segment in path.split("."):
        quoted = "['" + segment.replace("'", "\\'") + "']"
        options.append([quoted, f"[{segment}]"] if segment.isdigit() else [quoted])
    return ["$" + "".join(p) for p in product(*options)]


def get_path(v: Column, path: str, kind: str = "variant") -> Column:
    """Value at ``a.b.0``; null when absent. JSON null counts as absent."""
    if kind in ("variant", "json"):
        hits = F.array(*[F.try_variant_get(v, p, "variant") for p in _paths(path)])
        found = F.try_element_at(F.filter(hits, lambda x: x.isNotNull() & ~F.is_variant_null(x)), F.lit(1))
        return F.to_json(found) if kind == "json" else found
    return F.coalesce(*[F.try_variant_get(v, p, kind) for p in _paths(path)])


def _truthy(v: Column) -> Column:
    """Value as text; null for '', and for zero and false unless they are texts themselves."""
    def choose(r: Column) -> Column:
        dull = r["s"].isin("0", "false", "0.0") & (F.schema_of_variant(r["v"]) != "STRING")
        return F.when((r["s"] != "") & ~dull, r["s"])

    return let(F.struct(v.alias("v"), F.try_variant_get(v, "$", "string").alias("s")), choose)


def text_at(v: Column, *paths: str) -> Column:
    """First path with text, stripped; '' when none. Zero, false and '' are skipped like the source's ``or`` chains."""
    values = F.array(*[_truthy(get_path(v, path)) for path in paths])
    hit = F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(1))
    return F.coalesce(strip(hit), F.lit(""))


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def canonical_json(v: Column) -> Column:
    """Same text for structurally equal values: object keys come out sorted."""
    return F.to_json(v)


EMPTY = "{}"


def _first_that(candidates: Sequence[Column], test) -> Column:
    """First candidate that passes the test, else an empty object."""
    hits = F.filter(F.array(*candidates), lambda x: x.isNotNull() & test(x))
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.parse_json(F.lit(EMPTY)))


def response_data(v: Column, paths: Sequence[str] = ("responseObject.responseData", "responseData", "data")) -> Column:
    """First object or list among the envelope paths, else an empty object."""
    return let(v, lambda x: _first_that([get_path(x, p) for p in paths], lambda y: is_object(y) | is_list(y)))


def detail_data(v: Column) -> Column:
    """The ``data_list`` object inside the response data, else the response data when it is an object."""
    return let(F.struct(response_data(v).alias("data"), get_path(v, "data").alias("own")), lambda r: _first_that(
        [F.when(is_object(r.data), get_path(r.data, "data_list")), r.data, r.own], is_object))


def as_items(v: Column) -> Column:
    """Objects of a list value as an array of variants; empty when the value is no list."""
    items = F.filter(F.try_variant_get(v, "$", "array<variant>"), is_object)
    return F.coalesce(items, F.array().cast("array<variant>"))


def records_of(v: Column, keys: Sequence[str] = RECORD_KEYS) -> Column:
    """Objects of the first list found under the known keys, else of a top-level list."""
    return let(response_data(v), lambda data: as_items(_first_that(
        [F.when(is_object(data), get_path(data, k)) for k in keys] + [data], is_list)))


def page_info(v: Column) -> Column:
    """Page number, size, totals and last flag with defaults 1, 0, 0, 0, false."""
    def read(info: Column) -> Column:
        number = lambda key, default: F.coalesce(F.nullif(get_path(info, key, "bigint"), F.lit(0).cast("bigint")), F.lit(default).cast("bigint"))
        return F.struct(
            number("currentPageNum", 1).alias("current_page_num"), number("pageSize", 0).alias("page_size"),
            number("totalPageCount", 0).alias("total_page_count"), number("totalCount", 0).alias("total_count"),
            F.coalesce(get_path(info, "lastPage", "boolean"), F.lit(False)).alias("last_page"))

    return let(_first_that([get_path(response_data(v), "pageInfo"), get_path(v, "data.pageInfo")], is_object), read)


def pick_path(v: Column, paths: Sequence[str]) -> Column:
    """First path that exists; a hit that is no object gives an empty object."""
    hit = F.coalesce(*[get_path(v, p) for p in paths])
    return _first_that([hit], is_object)


def enveloped(c: Column | str, content: str = "content", records: str = "result.records", total: str = "result.totalcount") -> Column:
    """Payload whose content is JSON text again: struct of record array and total."""
    inner = parse_payload(get_path(parse_payload(c), content, "string"))
    return let(inner, lambda v: F.struct(as_items(get_path(v, records)).alias("records"),
                                         F.coalesce(get_path(v, total, "bigint"), F.lit(0).cast("bigint")).alias("total")))


def flatten_list(v: Column, fields: Mapping[str, Sequence[str]], dates: Sequence[str] = ()) -> Column:
    """List of objects to typed rows: aliases per field, month dates, all-blank rows dropped. Each object is opened once."""
    def text(item: Column, aliases: Sequence[str]) -> Column:
        values = F.array(*[_truthy(F.try_element_at(item, F.lit(a))) for a in aliases])
        hit = F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(1))
        return F.coalesce(strip(hit), F.lit(""))

    def row(item: Column) -> Column:
        return F.struct(*[(month_text(text(item, aliases)) if name in dates else text(item, aliases)).alias(name) for name, aliases in fields.items()])

    opened = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "map<string,variant>")), lambda m: m.isNotNull())
    rows = F.filter(F.transform(opened, row), lambda r: F.concat(*[r[n] for n in fields]) != "")
    none = F.array().cast(f"array<struct<{','.join(f'{n}:string' for n in fields)}>>")
    return F.coalesce(rows, none)


def join_objects(rows: Column, fields: Sequence[str]) -> Column:
    """Fields by blank, rows by comma, empty parts skipped."""
    line = lambda r: F.concat_ws(" ", *[F.when(strip(r[f]) != "", strip(r[f])) for f in fields])
    return F.array_join(F.filter(F.transform(rows, line), lambda x: x != ""), ",")


def parse_tags(tags: Column, level_markers: Sequence[str], ownership: Sequence[str], synonyms: Mapping[str, str]) -> Column:
    """First level-like tag (synonyms applied), first ownership tag, first other tag."""
    is_level = lambda x: any_contains(x, level_markers)
    is_owner = lambda x: any_contains(x, ownership)
    first = lambda arr: F.coalesce(F.try_element_at(arr, F.lit(1)), F.lit(""))
    level = first(F.filter(tags, is_level))
    # The first level-like tag is the level; a later one may still be an ownership or other tag.
    level_at = F.array_position(F.transform(tags, is_level), F.lit(True))
    rest = F.filter(tags, lambda x, i: i + 1 != level_at)
    owner_at = F.array_position(F.transform(rest, is_owner), F.lit(True))
    return F.struct(mapped(level, synonyms, level).alias("level"), first(F.filter(rest, is_owner)).alias("ownership"),
                    first(F.filter(rest, lambda x, i: i + 1 != owner_at)).alias("kind"))


def strip_keys(items: Column, keys: Sequence[str]) -> Column:
    """Named keys removed from every map of the list."""
    return F.transform(items, lambda m: F.map_filter(m, lambda k, _: ~k.isin(*keys)))


def as_list(c: Column) -> Column:
    """A scalar becomes a one-item list, blank an empty list."""
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.array(c))


def contact_struct(unit: Column, name: Column, phone: Column) -> Column:
    """Two label-prefixed lists with the non-empty parts only."""
    line = lambda label, c: F.when(c != "", F.concat(F.lit(label), c))
    return F.struct(F.array_compact(F.array(line("名称：", unit))).alias("purchasing"),
                    F.array_compact(F.array(line("项目联系人：", name), line("电话：", phone))).alias("project"))


def first_or_join(single: Column, names: Column, sep: str = " / ") -> Column:
    """The single value, else the list's names joined."""
    kept = F.filter(F.transform(names, strip), lambda x: x != "")
    return F.when(strip(single) != "", strip(single)).otherwise(F.coalesce(F.array_join(kept, sep), F.lit("")))


def remap_keys(v: Column, table: Mapping[str, str], nested: str | None = None, nested_table: Mapping[str, str] | None = None) -> Column:
    """Native labels to canonical names, one nested list included."""
    fields = [text_at(v, src).alias(dst) for src, dst in table.items()]
    if nested and nested_table:
        rows = F.transform(as_items(get_path(v, nested)),
                           lambda r: F.struct(*[text_at(r, s).alias(d) for s, d in nested_table.items()]))
        fields.append(rows.alias("result"))
    return F.struct(*fields)
