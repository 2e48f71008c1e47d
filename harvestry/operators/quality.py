"""Record checks: every check adds issues, the summary counts them and shows the first ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.jsonx import get_path
from harvestry.functions.text import is_blank
from harvestry.operators.ordering import with_previous
from harvestry.session import pinned

REPORT_LIMIT = 50


@dataclass(frozen=True)
class Checks:
    """What one dataset must satisfy. Paths are dotted and read a VARIANT record."""

    require: Sequence[str] = ()
    non_empty: Sequence[str] = ()
    unique_by: Sequence[str] = ()
    min_records: int = 0
    entity_type: str | None = None
    entity_path: str = "entity_type"
    report_limit: int = field(default=REPORT_LIMIT)


def _issue(kind: str, path: str, rank: int, bad: Column) -> Column:
    return F.when(bad, F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("issue"), F.lit(path).alias("field")))


def value_is_empty(value: Column) -> Column:
    """Blank string or empty container; numbers and booleans are never empty."""
    text = F.to_json(value)
    return text.isin("[]", "{}") | (text.startswith('"') & is_blank(F.try_variant_get(value, "$", "string")))


def record_issues(record: Column, checks: Checks) -> Column:
    """Array of the issues one record shows by itself."""
    found, rank = [], 0
    if checks.entity_type is not None:
        actual = get_path(record, checks.entity_path, "string")
        found.append(_issue("entity_type", checks.entity_path, rank, ~actual.eqNullSafe(F.lit(checks.entity_type))))
        rank += 1
    for path in checks.require:
        found.append(_issue("missing", path, rank, get_path(record, path).isNull()))
        rank += 1
    for path in checks.non_empty:
        value = get_path(record, path)
        found.append(_issue("missing_non_empty", path, rank, value.isNull()))
        found.append(_issue("empty", path, rank, value.isNotNull() & value_is_empty(value)))
        rank += 1
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<rank:int,issue:string,field:string>>")


def _narrow(df: DataFrame, record: str, position: str, checks: Checks) -> DataFrame:
    """The only pass over the records: position, the issues of each record by itself, and the parts of its key. Nested parts compare by structure."""
    parts = [get_path(F.col(record), p, "json").alias(f"_k{i}") for i, p in enumerate(checks.unique_by)]
    rows = df.select(position, record_issues(F.col(record), checks).alias("_issues"), *parts)
    return pinned(rows) if parts else rows


def _issues(narrow: DataFrame, position: str, checks: Checks) -> DataFrame:
    own = narrow.select(position, F.explode("_issues").alias("i")).select(position, "i.*")
    if not checks.unique_by:
        return own
    names = [f"_k{i}" for i in range(len(checks.unique_by))]
    complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    # Rows are range-split on (key, position), so a key on a third of the rows spans many tasks; a row that has one of its key before it is a repeat.
    repeated = with_previous(narrow.filter(complete).select(position, *names), names, [position], position).filter(F.col("previous").isNotNull())
    out = lambda d, kind: d.select(position, F.lit(1000).alias("rank"), F.lit(kind).alias("issue"), F.lit(",".join(checks.unique_by)).alias("field"))
    return own.unionByName(out(narrow.filter(~complete), "key_incomplete")).unionByName(out(repeated, "duplicate_key"))


def validate(df: DataFrame, record: str, position: str, checks: Checks) -> DataFrame:
    """All record issues: position (unique), rank, issue, field. Incomplete keys, and every occurrence of a key after the first, are issues, too."""
    return _issues(_narrow(df, record, position, checks), position, checks)


def validation_report(df: DataFrame, record: str, position: str, checks: Checks) -> DataFrame:
    """One row: records, issues, ok flag, the first issues in order and how many more there are."""
    narrow = _narrow(df, record, position, checks)
    issues = _issues(narrow, position, checks)
    sample = (issues.orderBy(position, "rank", "issue").limit(checks.report_limit)
              .agg(F.array_sort(F.collect_list(F.struct(position, "rank", "issue", "field"))).alias("first_issues")))
    totals = narrow.agg(F.count("*").alias("records"))
    found = issues.agg(F.count("*").alias("_found"))
    # Three one-row tables meet in an aggregate, not in a join.
    stacked = totals.unionByName(found, allowMissingColumns=True).unionByName(sample, allowMissingColumns=True)
    one = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("records", "_found", "first_issues")])
    short = F.when(F.col("records") < checks.min_records, 1).otherwise(0)
    return one.select("records", (F.col("_found") + short).alias("issues"), (F.col("_found") + short == 0).alias("ok"),
                      F.greatest(F.col("_found") + short - checks.report_limit, F.lit(0)).alias("more"), "first_issues")


def min_records(df: DataFrame, n: int) -> DataFrame:
    """Dataset-level check."""
    return df.agg(F.count("*").alias("records")).select("records", F.lit(n).cast("bigint").alias("minimum"), (F.col("records") >= n).alias("ok"))


def page_overlap(df: DataFrame, page: str, key: str) -> DataFrame:
    """Keys a page shares with the page before it, per page."""
    rows = df.select(page, key).distinct()
    after = rows.select((F.col(page) + 1).alias(page), key)
    shared = rows.join(after, [page, key]).groupBy(page).agg(F.count("*").alias("shared"))
    sizes = rows.groupBy(page).agg(F.count("*").alias("keys"))
    return sizes.join(shared, page, "left").withColumn("shared", F.coalesce("shared", F.lit(0)))


def coverage(df: DataFrame, group: str, key: str, fields: Sequence[str], low: int, high: int) -> DataFrame:
    """Rows, distinct keys, filled share per field and a plausible-count flag per group."""
    filled = [F.count_if(~is_blank(F.col(f).cast("string"))).alias(f"{f}_filled") for f in fields]
    return (df.groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"), *filled)
            .withColumn("plausible", F.col("rows").between(low, high)))


def page_mismatch(df: DataFrame, requested: Column, payload: Column, page_path: str, error_code: int, error_text: str,
                  code_path: str = "code", text_path: str = "msg") -> DataFrame:
    """Pages to fetch again: error in the body or another page number than asked for, with the reason."""
    actual = get_path(payload, page_path, "bigint")
    failed = get_path(payload, code_path, "bigint").eqNullSafe(F.lit(error_code)) | get_path(payload, text_path, "string").eqNullSafe(F.lit(error_text))
    reason = F.when(failed, "error").when(actual.isNotNull() & (actual != requested), "page_mismatch")
    return df.withColumn("retry_reason", reason).filter(F.col("retry_reason").isNotNull())
