"""Projections, fills, filters and rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import any_contains, collapse, is_blank, let, norm_text, one_of, strip, strip_edge_noise
from harvestry.specs import words


def project(df: DataFrame, mapping: Mapping[str, str], required: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Rename to the target layout, strip, default ''. A blank required value fails the job, or drops the row when not strict."""
    known = set(df.columns)
    out = df.select(*[F.coalesce(strip(F.col(src).cast("string")), F.lit("")).alias(dst) if src in known
                      else F.lit("").alias(dst) for dst, src in mapping.items()])
    for name in required:
        if strict:
            # A condition on kept rows: pruning columns, or counting, cannot drop it.
            out = out.filter(F.when(F.col(name) == "", F.raise_error(F.lit(f"missing {name}")).cast("boolean")).otherwise(True))
        else:
            out = out.filter(F.col(name) != "")
    return out


def alias_chain(df: DataFrame, targets: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Each target takes the first non-empty source of its own priority list; missing sources are skipped."""
    known = set(df.columns)

    def chain(sources: Sequence[str]) -> Column:
        picks = [F.when(F.col(s).cast("string") != "", F.col(s).cast("string")) for s in sources if s in known]
        return F.coalesce(strip(F.coalesce(*picks, F.lit(""))), F.lit(""))

    return df.select(*keep, *[chain(srcs).alias(t) for t, srcs in targets.items()])


def fill_if_empty(target: Column, value: Column) -> Column:
    """Keep the old value; take the new one only when the old one is empty."""
    text = norm_text(value, entities=False)
    return F.when(target.isNull() | (target == ""), F.when(text != "", text).otherwise(target)).otherwise(target)


def set_if_present(target: Column, value: Column) -> Column:
    """Take the new value whenever there is one."""
    text = norm_text(value, entities=False)
    return F.when(text != "", text).otherwise(target)


def reset_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Listed fields back to their empty value."""
    kinds = dict(df.dtypes)
    empties = {n: F.array().cast(kinds[n]) if kinds[n].startswith("array") else
               F.create_map().cast(kinds[n]) if kinds[n].startswith("map") else F.lit("") for n in names}
    return df.withColumns(empties)


def compact(m: Column, keys: Sequence[str] | None = None) -> Column:
    """Drop empty entries of a map: all keys, or only the listed ones."""
    return F.map_filter(m, lambda k, v: ~((k.isin(*keys) if keys else F.lit(True)) & (v.isNull() | (v == ""))))


def missing_fields(names: Sequence[str]) -> Column:
    """Names of the listed columns that are blank."""
    return F.array_compact(F.array(*[F.when(is_blank(F.col(n).cast("string")), F.lit(n)) for n in names]))


def require_fields(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with the list of missing names)."""
    marked = df.withColumn("missing", missing_fields(names))
    return marked.filter(F.size("missing") == 0).drop("missing"), marked.filter(F.size("missing") > 0)


def keep_or_reject(df: DataFrame, rules: Sequence[tuple[Column, str]], name: str = "reject_reason") -> DataFrame:
    """Ordered rules; the first one that fires gives the reason, '' when none does."""
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rules, F.when(F.lit(False), ""))
    return df.withColumn(name, chain.otherwise(""))


def is_placeholder_name(name: Column, word: str = words.PLACEHOLDER_PERSON_WORD) -> Column:
    return let(strip_edge_noise(name), lambda text: text.contains(word) | text.rlike(r"^\d+$") | (F.length(text) < 2))


def is_viable_entity_name(name: Column, keywords: Sequence[str] = words.ENTITY_KEYWORDS,
                          placeholders: Sequence[str] = words.PLACEHOLDER_ENTITY_NAMES,
                          suspicious: Sequence[str] | None = None) -> Column:
    """Worth resolving: long enough, has letters, no decorations, holds a domain keyword; the strict form bars suspicious words."""
    def judge(text: Column) -> Column:
        sound = (F.length(text) >= 2) & ~text.rlike(r"^\d+$") & any_contains(text, keywords)
        if suspicious is not None:
            return sound & ~any_contains(F.lower(text), [w.lower() for w in suspicious])
        return (sound & ~text.isin(*placeholders) & text.rlike("[A-Za-z\\x{4e00}-\\x{9fff}]")
                & ~text.rlike(f"[{words.DECORATIVE_CHARS}]"))

    return let(strip_edge_noise(name), judge)


def all_blank(names: Sequence[str]) -> Column:
    """Every listed field is '' or missing."""
    return reduce(lambda a, b: a & b, [F.col(n).isNull() | (F.col(n) == "") for n in names])


def backfill_candidates(df: DataFrame, text: str, exclude: str, flag: str, first: str, second: str,
                        second_blank: Sequence[str] = ("", "void 0"), columns: Sequence[str] = ()) -> DataFrame:
    """Rows with usable text, not closed by the flag, and at least one of two fields still open."""
    open_second = F.col(second).isNull() | F.col(second).isin(*second_blank)
    wanted = ((F.col(text) != "") & ~F.col(text).rlike(exclude) & (F.col(flag).isNull() | (F.col(flag) != "N"))
              & (F.col(first).isNull() | (F.col(first) == "") | open_second))
    return df.filter(wanted).select(*(columns or df.columns))


def not_yet_migrated(df: DataFrame, value: str, origin: str, order: Sequence[str], limit: int = 0) -> DataFrame:
    """Value present and origin still empty, in id order."""
    todo = df.filter((F.col(value) != "") & (F.col(origin).isNull() | (F.col(origin) == ""))).orderBy(*order)
    return todo.limit(limit) if limit > 0 else todo


def on_date(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows whose date text equals the day after normalising; a real date column is compared natively and pushes down."""
    from harvestry.functions.dates import iso_date

    kind = dict(df.dtypes)[column]
    if kind == "string":
        return df.filter(iso_date(column) == day)
    start = F.lit(day).cast("date").cast(kind)
    return df.filter((F.col(column) >= start) & (F.col(column) < F.date_add(F.lit(day).cast("date"), 1).cast(kind)))


def allow_list(df: DataFrame, allowed: Mapping[str, Sequence[str]], module: str, kind: str, code: str, all_word: str) -> DataFrame:
    """Rows with a code, not the "all" entry, and on the list of their module. Modules without a list pass."""
    ok = reduce(lambda acc, kv: acc.when(F.col(module) == kv[0], F.col(kind).isin(*kv[1])), allowed.items(), F.when(F.lit(False), F.lit(True)))
    return df.filter(~is_blank(F.col(code).cast("string")) & (F.col(kind) != all_word) & ok.otherwise(True))


def threshold_expand(df: DataFrame, count: str, threshold: int, children: str, keep: Column, names: Sequence[str]) -> DataFrame:
    """Children of parents above the threshold only; ``keep`` judges one child struct called ``child``."""
    parents = df.filter(F.col(count) > threshold)
    return parents.select(*names, F.explode(children).alias("child")).filter(keep).select(*names, "child.*")


def classify_response(status: Column, body: Column) -> Column:
    """Ordered reading of a landed response. Blocked is not the same as empty."""
    lowered = F.lower(body)
    redirect = body.contains("location.href")
    return (F.when(body.contains("__jsl_clearance_s") & redirect, "jsl_challenge")
            .when((status == 521) & body.contains("document.cookie") & redirect, "jsl_challenge")
            .when((status == 412) & lowered.contains("environment checking"), "environment_check")
            .when(body.contains("nwaf页面") | body.contains('id="wafId"'), "waf_block")
            .when(status == 200, "ok").otherwise("unknown"))


def classify_probe(status: Column, body: Column) -> Column:
    """The second site's reading: captcha before script challenge before block, whatever the status of the first two."""
    shows = lambda marks: any_contains(F.coalesce(body, F.lit("")), marks)
    return (F.when(shows([words.PROBE_CAPTCHA]), "captcha")
            .when(status.eqNullSafe(F.lit(words.PROBE_SCRIPT_STATUS)) | shows(words.PROBE_SCRIPT), "521_js")
            .when(status.eqNullSafe(F.lit(words.PROBE_BLOCK_STATUS)) & shows(words.PROBE_BLOCK), "403_block")
            .when(status == 200, "ok").otherwise("other"))


def block_event_id(body: Column) -> Column:
    """Id of a firewall event, null when the page shows none."""
    found = strip(F.regexp_extract(body, r'(?i)<span id="wafId">([^<]+)</span>', 1))
    return F.when(found != "", found)


def is_noise_text(text: Column, help_url: str = words.NOISE_HELP_PATH, login_path: str = words.NOISE_LOGIN_PATH) -> Column:
    """Page furniture; a keep-marker anywhere in the text overrides everything."""
    def judge(r: Column) -> Column:
        prefixed = reduce(lambda a, b: a | b, [r.low.startswith(p.lower()) for p in words.NOISE_PREFIXES])
        return (F.when((r.value == "") | any_contains(r.value, words.KEEP_TEXT_MARKERS), False)
                .when(r.value.startswith(words.NOISE_BREADCRUMB) | r.value.isin(*words.NOISE_EXACT_TEXTS) | prefixed, True)
                .when(r.low.contains(help_url), True)
                .otherwise(r.low.startswith("http") & r.low.contains(login_path)))

    value = collapse(text)
    return let(F.struct(value.alias("value"), F.lower(value).alias("low")), judge)


def is_blank_detail(module: Column, kind: Column, title: Column, labels: Column, n_result_rows: Column, *texts: Column,
                    tasks: Sequence[tuple[str, str]] = words.BLANK_DETAIL_TASKS) -> Column:
    """For the configured tasks: no result rows, no real labels, and only title or boilerplate lines."""
    from harvestry.functions.text import first_non_empty

    bound = reduce(lambda a, b: a | b, [(module == m) & (kind == k) for m, k in tasks])
    shown = F.coalesce(*[F.when(~is_blank(t), t) for t in texts], F.lit(""))
    lines = F.filter(F.transform(F.split(shown, "[\r\n]+"), collapse), lambda x: x != "")
    real = F.filter(lines, lambda x: ~((title != "") & (x == collapse(title))) & ~x.rlike("|".join(words.BOILERPLATE_LINES)))
    labelled = F.exists(labels, lambda k: (k != "") & ~k.isin(*words.STRUCTURAL_ONLY_LABELS))
    empty = first_non_empty(*texts) == ""
    return bound & (empty | ((n_result_rows == 0) & ~labelled & (F.size(real) == 0)))


def is_shell_page(html: Column, title: str = words.SHELL_TITLE, markers: Sequence[str] = words.SHELL_CONTENT_MARKERS) -> Column:
    """Has the frame's title but none of the content markers."""
    return html.contains(title) & ~html.rlike(one_of(markers))
