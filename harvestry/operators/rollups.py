"""Aggregates: summaries, merges and status flags. All combine map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.jsonx import get_path, is_object
from harvestry.functions.text import collapse, is_blank, strip, strip_edge_noise
from harvestry.operators.ordering import group_ordinal, keep_last, name_order
from harvestry.operators.shaping import is_viable_entity_name
from harvestry.specs import words

SAMPLE_SIZE = 20


def clean_names(df: DataFrame, name: str, viable=is_viable_entity_name) -> DataFrame:
    """Raw names with their normalised form and whether they are worth resolving."""
    return df.select(F.col(name).alias("raw"), strip_edge_noise(F.col(name)).alias("normalized"), viable(F.col(name)).alias("viable"))


def clean_candidates(df: DataFrame, name: str, viable=is_viable_entity_name) -> DataFrame:
    """Distinct usable names in display order."""
    names = clean_names(df, name, viable).filter("viable").select(F.col("normalized").alias("name")).distinct()
    return names.orderBy(*name_order(F.col("name")))


def candidate_summary(df: DataFrame, name: str, order: Sequence[str], viable=is_viable_entity_name) -> DataFrame:
    """Raw, candidate, filtered and merged counts plus the first filtered samples."""
    marked = df.select(*order, F.col(name).alias("raw"), viable(F.col(name)).alias("viable"), strip_edge_noise(F.col(name)).alias("normalized"))
    counts = marked.agg(F.count("*").alias("raw_count"), F.countDistinct(F.when(F.col("viable"), F.col("normalized"))).alias("candidate_count"),
                        F.count_if(~F.col("viable")).alias("filtered_count"), F.count_if(F.col("viable")).alias("_ok"))
    samples = (marked.filter(~F.col("viable")).orderBy(*order).limit(SAMPLE_SIZE)
               .agg(F.array_sort(F.collect_list(F.struct(*order, "raw", "normalized"))).alias("filtered_examples")))
    # Two one-row tables meet in an aggregate, not in a join.
    both = counts.unionByName(samples, allowMissingColumns=True).agg(*[F.first(c, ignorenulls=True).alias(c) for c in [*counts.columns, "filtered_examples"]])
    return both.select("raw_count", "candidate_count", "filtered_count",
                       (F.col("_ok") - F.col("candidate_count")).alias("merged_count"), "filtered_examples")


def merge_fill(df: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """One row per key; each field is its first non-blank value in order. Keys without the required fields are dropped."""
    position = F.struct(*[F.col(o) for o in order])
    usable = df.filter(~is_blank(F.col(key).cast("string")))
    firsts = [F.min_by(F.col(f), F.when(~is_blank(F.col(f).cast("string")), position)).alias(f) for f in fields]
    merged = usable.groupBy(key).agg(*firsts)
    for name in required:
        merged = merged.filter(~is_blank(F.col(name).cast("string")))
    return merged


def classify_member(df: DataFrame, member: str) -> DataFrame:
    """Queue member in any of its historic shapes: plain URL, ``{"url": …}`` or JSON string."""
    text = strip(F.col(member))
    value = F.try_parse_json(text)
    url = F.when(is_object(value), strip(get_path(value, "url", "string"))).when(
        F.to_json(value).startswith('"'), strip(F.try_variant_get(value, "$", "string")))
    marked = df.withColumns({"_text": text, "_bad": value.isNull() & ~text.isin("NaN", "Infinity", "-Infinity"), "_url": url})
    kind = (F.when(F.coalesce(F.col("_text"), F.lit("")) == "", "invalid").when(F.col("_bad"), "legacy")
            .when(F.coalesce(F.col("_url"), F.lit("")) != "", "json").otherwise("invalid"))
    return (marked.withColumn("kind", kind)
            .withColumn("url", F.when(F.col("kind") == "legacy", F.col("_text")).when(F.col("kind") == "json", F.col("_url")))
            .drop("_text", "_bad", "_url"))


def migration_plan(df: DataFrame, member: str) -> DataFrame:
    """Counts per shape; duplicates are what is neither unique nor invalid."""
    marked = classify_member(df, member)
    counts = marked.agg(
        F.count("*").alias("total"), F.countDistinct("url").alias("unique"),
        F.count_if(F.col("kind") == "legacy").alias("legacy"), F.count_if(F.col("kind") == "json").alias("json"),
        F.count_if(F.col("kind") == "invalid").alias("invalid"))
    return counts.withColumn("duplicate", F.col("total") - F.col("unique") - F.col("invalid"))


def run_summary(df: DataFrame, key: str, page: str, valid: Column) -> DataFrame:
    """Raw, unique, duplicate, upserted and skipped-invalid counts and the last page."""
    good = F.when(valid, F.col(key))
    counts = df.agg(F.count("*").alias("raw_count"), F.countDistinct(good).alias("unique_count"),
                    F.count_if(~F.coalesce(valid, F.lit(False))).alias("skipped_invalid"), F.max(page).alias("last_page"))
    return counts.select("raw_count", "unique_count",
                         (F.col("raw_count") - F.col("unique_count") - F.col("skipped_invalid")).alias("duplicate_count"),
                         F.col("unique_count").alias("upserted_count"), "skipped_invalid", "last_page")


SUCCESS, SITE, CONTENT, NEW, VALID = "WasSuccessful", "WebsiteError", "HasContent", "HasNewData", "IsValidData"
# What each run event does to the flags; a run starts at 1, 1, 0, 0, 1.
FLAG_EFFECTS = {
    "run_failed": {SUCCESS: 0}, "website_error": {SITE: 0}, "has_content": {CONTENT: 1},
    "has_new_data": {NEW: 1}, "invalid_data": {VALID: 0},
    "list_failed": {SUCCESS: 0, SITE: 0}, "detail_failed": {SUCCESS: 0, SITE: 0, VALID: 0},
}


def flag_columns(kind: Column, effects: Mapping[str, Mapping[str, int]] = FLAG_EFFECTS) -> list[Column]:
    """Five flag aggregates over run events."""
    out = []
    for flag, start, fold in ((SUCCESS, 1, F.min), (SITE, 1, F.min), (CONTENT, 0, F.max), (NEW, 0, F.max), (VALID, 1, F.min)):
        hits = [k for k, e in effects.items() if flag in e]
        value = F.when(kind.isin(*hits), 1 - start).otherwise(start)
        out.append(fold(value).cast("int").alias(flag))
    return out


def biz_type(module: Column, sub_type: Column) -> Column:
    """``module-sub`` when there is a sub-type, else whichever part exists."""
    m, s = F.coalesce(strip(module), F.lit("")), F.coalesce(strip(sub_type), F.lit(""))
    return F.when((m != "") & (s != ""), F.concat_ws("-", m, s)).when(m != "", m).otherwise(s)


def monitor_status(events: DataFrame, keys: Sequence[str], run: str, ts: str, kind: str,
                   effects: Mapping[str, Mapping[str, int]] = FLAG_EFFECTS) -> DataFrame:
    """Flags of the last run per key: folded inside a run, last flush wins across runs."""
    runs = events.groupBy(*keys, run).agg(*flag_columns(F.col(kind), effects), F.max(ts).alias("flushed_at"))
    return keep_last(runs, list(keys), ["flushed_at", run])


def count_by_group(df: DataFrame, module: str, kind: str) -> DataFrame:
    """Records per (module, type), per module and overall."""
    base = df.groupBy(module, kind).agg(F.count("*").alias("n"))
    per_module = base.groupBy(module).agg(F.sum("n").alias("n"))
    level = lambda d, name, m, k: d.select(F.lit(name).alias("level"), m.alias("module"), k.alias("kind"), "n")
    none = F.lit(None).cast("string")
    return (level(base, "type", F.col(module), F.col(kind))
            .unionByName(level(per_module, "module", F.col(module), none))
            .unionByName(level(per_module.agg(F.sum("n").alias("n")), "all", none, none)))


def status_counts(df: DataFrame, status: Column, name: str = "status") -> DataFrame:
    return df.groupBy(status.alias(name)).agg(F.count("*").alias("n"))


def max_page(html: Column, pattern: str) -> Column:
    """Highest page number linked, at least 1."""
    numbers = F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), lambda x: x.try_cast("bigint"))
    return F.greatest(F.coalesce(F.array_max(numbers), F.lit(1).cast("bigint")), F.lit(1).cast("bigint"))


def attempt_log(attempts: DataFrame, task: str, order: Sequence[str]) -> DataFrame:
    """Attempts of every task in id order. A sorted table, so a task with endless retries is never one value."""
    return attempts.orderBy(task, *order)


def checkpoints_as_map(df: DataFrame, task: str, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """task → map of each key's latest value."""
    latest = keep_last(df, [task, key], order)
    return latest.groupBy(task).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias("checkpoints"))


def checkpoint_pieces(df: DataFrame, task: str, key: str, value: str, order: Sequence[str], size: int = 1000) -> DataFrame:
    """(task, piece) → map of at most ``size`` latest values, keys ascending over the pieces, so that no value grows with the task.

    Keys are numbered by range-split ordinals: a task's keys span many partitions. Null keys have no place in a map and are left out.
    """
    latest = keep_last(df.filter(F.col(key).isNotNull()), [task, key], order).select(task, key, value)
    placed = group_ordinal(latest, [task], [key], "_n").withColumn("piece", F.floor((F.col("_n") - 1) / size))
    entries = F.array_sort(F.collect_list(F.struct(key, value)))
    return placed.groupBy(task, "piece").agg(F.min(key).alias("first_key"), F.count("*").alias("n_keys"), F.map_from_entries(entries).alias("checkpoints"))


def new_members(batch: DataFrame, existing: DataFrame, member: str) -> DataFrame:
    """Members of the batch that the set does not hold yet. Both sides are reduced map-side, so no member is more than a row a task."""
    return batch.select(member).distinct().join(existing.select(member).distinct(), member, "left_anti")
