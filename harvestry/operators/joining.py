"""Merges, lookups and entity resolution, all as equi joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import is_blank, match_key, safe_key, strip
from harvestry.operators.ordering import keep_first, keep_last
from harvestry.session import pinned, written


def merge_detail(rows: DataFrame, details: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """List rows with detail values on top: a non-empty detail value wins. ``details`` holds one row per key."""
    picked = details.select(key, *[F.col(f).alias(f"_d_{f}") for f in fields])
    merged = rows.join(picked, key, "left")
    taken = {f: F.coalesce(F.when(F.col(f"_d_{f}").cast("string") != "", F.col(f"_d_{f}")), F.col(f)) for f in fields}
    return merged.withColumns(taken).select(*rows.columns)


def overlay(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """Every overlay row, with its non-'' values laid over the base row; without a base it stands alone."""
    left = base.select(key, *[F.col(c).alias(f"_b_{c}") for c in base.columns if c != key])
    joined = over.join(left, key, "left")
    shown = [F.coalesce(F.when(F.col(c) != "", F.col(c)), F.col(f"_b_{c}"), F.col(c)).alias(c) if c in base.columns else F.col(c)
             for c in over.columns if c != key]
    return joined.select(key, *shown)


def processed_names(done: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-blank names from any of the columns."""
    # One pass over the table: both columns of a row are stacked, then deduplicated map-side.
    names = done.select(F.explode(F.array(*[strip(F.col(c)) for c in columns])).alias("name"))
    return names.filter(~is_blank(F.col("name"))).distinct()


def pending(candidates: DataFrame, name: str, done: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Candidates found in none of the processed columns."""
    seen = processed_names(done, columns).withColumnRenamed("name", name)
    return candidates.join(seen, name, "left_anti")


def pending_counts(candidates: DataFrame, name: str, done: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: candidates, those still pending and those skipped because they are done."""
    seen = written(processed_names(done, columns).select(F.col("name").alias(name), F.lit(True).alias("_done")), "seen")
    return candidates.join(seen, name, "left").agg(F.count("*").alias("candidates"), F.count_if(F.col("_done").isNull()).alias("pending"), F.count("_done").alias("skipped"))


def fk_counts(df: DataFrame, fk: str, invalid: Sequence[str] = ("", "0", "None", "null")) -> DataFrame:
    """One row: rows, those skipped for an unusable key, and distinct usable keys."""
    usable = F.coalesce(~strip(F.col(fk).cast("string")).isin(*invalid), F.lit(False))
    return df.agg(F.count("*").alias("rows"), F.count_if(~usable).alias("skipped"), F.countDistinct(F.when(usable, F.col(fk))).alias("keys"))


def resolve_entity(queries: DataFrame, query: str, reference: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Exact match on the comparison key first; else the one record whose key ends with the query's; else unresolved.

    The suffix rule is an equi join of narrow rows: records are numbered, each distinct key is counted and keeps its first record's number, and is stacked into the
    suffixes whose lengths occur among the queries. Suffixes are counted map-side before they meet the queries, so a suffix that all records share costs
    one row a task. Whole records are fetched last, by number, one for each key that has a match. ``order`` is unique among records of one key; where it
    is not, the record with the smallest values counts.
    """
    first = F.struct(*[F.col(o) for o in order], F.xxhash64(*[F.col(c).cast("string") for c in reference.columns]).alias("_hash"))
    keyed = reference.withColumn("_rkey", match_key(F.col(name))).withColumn("_first", first).filter(F.col("_rkey") != "")
    keys = pinned(keyed.groupBy("_rkey").agg(F.count("*").alias("_n"), F.min("_first").alias("_least")))
    wanted = pinned(queries.select(match_key(F.col(query)).alias("_key")).filter(F.col("_key") != "").distinct())
    # Lengths of names: a handful of numbers, whatever the number of queries.
    lengths = [r[0] for r in wanted.select(F.length("_key").alias("n")).distinct().collect()]
    tails = keys.select("_n", "_least", F.explode(F.filter(
        F.transform(F.lit(sorted(lengths)).cast("array<int>"), lambda n: F.when(n < F.length("_rkey"), F.expr("_rkey").substr(F.length("_rkey") - n + 1, n))), lambda x: x.isNotNull())).alias("_key"))
    counted = tails.groupBy("_key").agg(F.sum("_n").alias("_n"), F.min("_least").alias("_least")).filter("_n = 1")
    exact = keys.select(F.col("_rkey").alias("_key"), F.lit("exact").alias("match_kind"), "_least")
    found = exact.unionByName(counted.select("_key", F.lit("suffix").alias("match_kind"), "_least")).join(wanted, "_key", "left_semi")
    best = found.groupBy("_key").agg(F.min_by("_least", F.col("match_kind")).alias("_first"), F.min("match_kind").alias("match_kind"))
    # A record is asked for by its first-row mark; rows that agree in all columns are one.
    records = keyed.join(best.select("_first").distinct(), "_first", "left_semi").select("_first", *reference.columns).dropDuplicates(["_first"])
    hits = best.join(records, "_first").drop("_first")
    joined = queries.withColumn("_key", match_key(F.col(query))).join(hits, "_key", "left")
    return joined.select(*queries.columns, *reference.columns, F.coalesce("match_kind", F.lit("")).alias("match_kind"), F.when(F.col("match_kind").isNotNull(), "Y").otherwise("N").alias("resolved"))


def resolve_exact(queries: DataFrame, query: str, reference: DataFrame, name: str, order: Sequence[str], norm=None) -> DataFrame:
    """Normalised names equal; the first record in order. The records are reduced and written first, so that a hot name of the queries can be split."""
    from harvestry.functions.text import strip_edge_noise

    norm = norm or strip_edge_noise
    first = written(keep_first(reference.withColumn("_key", norm(F.col(name))), ["_key"], order), "records")
    return queries.withColumn("_key", norm(F.col(query))).join(first, "_key", "left").drop("_key")


def stitch(base: DataFrame, parts: Mapping[str, DataFrame], key: str, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several one-row-per-id parts joined; every field has its own source order, written ``part.column``."""
    joined = base
    for label, part in parts.items():
        joined = joined.join(part.select(key, *[F.col(c).alias(f"{label}__{c}") for c in part.columns if c != key]), key, "left")

    def chain(sources: Sequence[str]) -> Column:
        cols = [F.col(s.replace(".", "__")).cast("string") for s in sources]
        return F.coalesce(strip(F.coalesce(*[F.when(c != "", c) for c in cols], F.lit(""))), F.lit(""))

    return joined.select(key, *[chain(srcs).alias(f) for f, srcs in fields.items()])


def fk_distinct(df: DataFrame, fk: str, invalid: Sequence[str] = ("", "0", "None", "null")) -> DataFrame:
    """Distinct usable foreign keys."""
    text = strip(F.col(fk).cast("string"))
    return df.filter(F.col(fk).isNotNull() & ~text.isin(*invalid)).select(fk).distinct()


def done_gate(tasks: DataFrame, key: str, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(detail tasks: every valid row, home tasks: rows whose id is not done yet)."""
    valid = tasks.filter(~is_blank(F.col(key).cast("string")))
    return valid, valid.join(written(done.select(key).distinct(), "done"), key, "left_anti")


def attach_by_id(rows: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attributes found elsewhere, attached by id; the last one found counts."""
    order = [c for c in extra.columns if c.startswith("pos")] or list(extra.columns)
    return rows.join(keep_last(extra, keys, order).drop(*[c for c in order if c.startswith("pos")]), list(keys), "left")


def code_lookup(df: DataFrame, code: str, table: DataFrame, label: str, default: str = "") -> DataFrame:
    """Code to label by join. The optimizer broadcasts the table only when its size is under the threshold."""
    codes = table.select(F.col(table.columns[0]).alias(code), F.col(table.columns[1]).alias(label))
    return df.join(codes, code, "left").withColumn(label, F.coalesce(F.col(label), F.lit(default)))


def expand_level(parents: DataFrame, children: DataFrame, parent_key: str, child_id: str, child_name: str) -> DataFrame:
    """One level of a hierarchy: children with id and name, carrying the parent's columns."""
    sound = children.filter(~is_blank(F.col(child_id).cast("string")) & ~is_blank(F.col(child_name).cast("string")))
    return sound.join(parents, parent_key)


def expert_children(df: DataFrame, parent_id: str, parent_name: str, children: str, prefix: str) -> DataFrame:
    """Children listed in a parent row, with a synthetic key of prefix, parent id and safe name."""
    flat = df.select(parent_id, parent_name, F.explode(children).alias("child_name")).filter(~is_blank(F.col("child_name")))
    key = F.concat_ws("_", F.lit(prefix), F.col(parent_id).cast("string"), safe_key(F.col("child_name")))
    return flat.withColumn("child_id", key)
