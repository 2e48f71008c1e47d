"""Readers, writers, joins, checks and streams on small literal tables."""

import pytest
from pyspark.sql import functions as F

from harvestry.functions.jsonx import get_path, parse_payload
from harvestry.operators import joining, quality, rollups, shaping
from harvestry.operators.trees import flatten_tree
from harvestry.session import scratch_path
from harvestry.sources import readers, writers
from harvestry.streaming import jobs


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("name,content", [("a.jsonl", '{"k":1}\n\n {"k":2}\n'), ("a.json", '[{"k":1},{"k":2}]'), ("b.json", '{"records":5,"items":[{"k":1},{"k":2}]}')])
def test_read_records_shapes(spark, tmp_path, name, content):
    df = readers.read_records(spark, put(tmp_path, name, content)).select(get_path(F.col("record"), "k", "int").alias("k"))
    assert sorted(r.k for r in df.collect()) == [1, 2]


@pytest.mark.parametrize("name,content", [("a.jsonl", "[1]\n"), ("a.jsonl", "  \n"), ("a.json", '{"x":[{"k":1}]}'), ("a.json", '[1,{"k":2}]')])
def test_read_records_rejects(spark, tmp_path, name, content):
    with pytest.raises(Exception):
        readers.read_records(spark, put(tmp_path, name, content)).collect()


def test_project_fails_on_missing_key(spark):
    df = spark.createDataFrame([("a",), (" ",)], "k string")
    with pytest.raises(Exception, match="missing key"):
        shaping.project(df, {"key": "k"}, ["key"]).collect()
    assert shaping.project(df, {"key": "k"}, ["key"], strict=False).count() == 1


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, n int")
    once = writers.upsert(base, updates, ["k"], ["n"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, writers.upsert(once, updates, ["k"], ["n"]).collect())) == sorted(map(tuple, once.collect()))


def test_safe_replace_refuses(spark):
    path = scratch_path(spark, "replace")
    spark.range(5).write.parquet(path)
    with pytest.raises(RuntimeError, match="count check"):
        writers.safe_replace(spark.range(3), path, 4)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(RuntimeError, match="temporary"):
        writers.safe_replace(spark.range(3), path, 3)
    assert writers.safe_replace(spark.range(3), path, 3, overwrite_temp=True) == 3
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(f"{path}__backup").count() == 5
    with pytest.raises(RuntimeError, match="backup"):
        writers.safe_replace(spark.range(2), path, 2)


def test_pending_covers_candidates(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    done = spark.createDataFrame([("a", " "), ("", "c"), (None, None)], "q string, h string")
    assert [r.name for r in joining.pending(names, "name", done, ["q", "h"]).collect()] == ["b"]


def test_resolve_entity(spark):
    ref = spark.createDataFrame([(1, "甲市第一医院"), (2, "乙市第一医院"), (3, "第二医院"), (4, "丙市第三医院"), (5, "第二医院")], "code int, name string")
    asked = spark.createDataFrame([("★第二医院",), ("第一医院",), ("第三医院",), ("甲市第一医院新区",), ("",)], "q string")
    got = {r.q: (r.code, r.match_kind) for r in joining.resolve_entity(asked, "q", ref, "name", ["code"]).collect()}
    assert got == {"★第二医院": (3, "exact"), "第一医院": (None, ""), "第三医院": (4, "suffix"), "甲市第一医院新区": (None, ""), "": (None, "")}


def test_migration_plan(spark):
    members = ["http://a", '{"url":"http://a"}', '"http://b"', "5", "[1]", "NaN", "  ", '{"x":1}', '{"url":" "}']
    plan = rollups.migration_plan(spark.createDataFrame([(m,) for m in members], "m string"), "m").first().asDict()
    assert plan == {"total": 9, "unique": 2, "legacy": 1, "json": 2, "invalid": 6, "duplicate": 1}


def test_validation_report_limits_and_orders(spark):
    df = spark.range(70).select("id", parse_payload(F.lit("{}")).alias("r"))
    report = quality.validation_report(df, "r", "id", quality.Checks(require=["a"], min_records=100)).first()
    assert (report.records, report.issues, report.ok, report.more, len(report.first_issues)) == (70, 71, False, 21, 50)
    assert [i.id for i in report.first_issues] == list(range(50))


def test_tree_depth_is_never_cut(spark):
    chain = spark.range(1, 71).select(F.col("id").alias("n"), F.when(F.col("id") > 1, F.col("id") - 1).alias("p"), F.col("id").alias("o"))
    assert {r.n: r.depth for r in flatten_tree(chain, "n", "p", "o").collect()} == {i: i - 1 for i in range(1, 71)}


def test_retry_counts_survive_batches_and_replay(spark):
    folder = scratch_path(spark, "retry")
    counts = jobs.BatchLog(spark, f"{folder}/counts", "url string, attempts bigint")
    decided = []
    for batch_id in (0, 1, 1):  # the last one is a replay
        rows = [("u", 10 * batch_id + i, 500) for i in range(2)] + [("u", 10 * batch_id + 9, 521)]
        batch = spark.createDataFrame(rows, "url string, n int, status int")
        ruled, added = jobs.retry_batch(batch, "url", ["n"], F.col("status").isin(403, 521), counts.read(batch_id), 3)
        decided.append(sorted((r.n, r.attempt, r.decision) for r in ruled.collect()))
        counts.write(added, batch_id)
    assert decided[0] == [(0, 1, "requeue"), (1, 2, "requeue"), (9, None, "requeue_blocked")]
    assert decided[1] == decided[2] == [(10, 3, "requeue"), (11, 4, "dead_letter"), (19, None, "requeue_blocked")]
