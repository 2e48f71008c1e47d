"""Order-dependent operators against plain Python, with one key holding most of the rows."""

from pyspark.sql import functions as F

from harvestry.operators import ledger, ordering, rollups


def hot(spark, n=4000):
    """Key 0 holds two thirds of the rows."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(0).alias("k"), F.col("id"), (F.col("id") * 7919 % 5).alias("v"))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_global_ordinal_crosses_partitions(spread):
    out = rows_of(ordering.global_ordinal(hot(spread), ["v", "id"]))
    want = {r["id"]: i for i, r in enumerate(sorted(out, key=lambda r: (r["v"], r["id"])), 1)}
    assert {r["id"]: r["ordinal"] for r in out} == want


def test_group_ordinal_splits_the_hot_key(spread):
    laid_out = ordering.range_sorted(hot(spread), ["k", "id"])
    assert laid_out.filter("k = 0").select(ordering.PART).distinct().count() > 1
    out = rows_of(ordering.group_ordinal(hot(spread), ["k"], ["id"]))
    seen = {}
    for r in sorted(out, key=lambda r: (r["k"], r["id"])):
        seen[r["k"]] = seen.get(r["k"], 0) + 1
        assert r["ordinal"] == seen[r["k"]]


def test_with_previous_carries_over_borders(spread):
    out = sorted(rows_of(ordering.with_previous(hot(spread), ["k"], ["id"], "v")), key=lambda r: (r["k"], r["id"]))
    for before, row in zip([None, *out], out):
        same = before is not None and before["k"] == row["k"]
        assert row["previous"] == (before["v"] if same else None)


def test_empty_input(spread):
    empty = hot(spread).filter("id < 0")
    assert ordering.global_ordinal(empty, ["id"]).count() == 0
    assert ordering.with_previous(empty, ["k"], ["id"], "v").count() == 0


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("", 0, "z"), (None, 5, "n"), ("b", 3, None)], "k string, o int, v string")
    assert {(r.k, r.v) for r in ordering.keep_first(df, ["k"], ["o"], drop_blank=True).collect()} == {("a", "y"), ("b", None)}
    assert {(r.k, r.v) for r in ordering.keep_last(df, ["k"], ["o"]).collect()} == {("a", "x"), ("b", None), ("", "z"), (None, "n")}


def test_stop_rule(spark):
    pages = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 0), ("a", 4, 10), ("b", 1, 10), ("b", 2, 4), ("b", 3, 10), ("c", 1, 10), ("c", 2, 10)], "s string, p int, n int")
    kept = {(r.s, r.p) for r in ordering.stop_rule(pages, ["s"], "p", "n", 10).collect()}
    assert kept == {("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1), ("c", 2)}


def test_transitions(spread):
    moves = [("t", 1, "pending"), ("t", 2, "queued"), ("t", 3, "done"), ("u", 1, "running"), ("u", 2, "done"), ("u", 3, "queued")]
    df = spread.createDataFrame(moves, "task string, n int, status string")
    bad = {(r.task, r.n) for r in ledger.transition_check(df, "task", ["n"], "status").collect()}
    assert bad == {("t", 3), ("u", 3)}


def test_checkpoint_pieces_of_a_hot_task(spread):
    rows = hot(spread).withColumn("key", F.when(F.col("id") == 3, None).otherwise(F.floor(F.col("id") / 2)))
    want = {}
    for r in sorted(rows_of(rows), key=lambda r: r["id"]):
        if r["key"] is not None:
            want.setdefault(r["k"], {})[r["key"]] = r["v"]
    got = sorted(rows_of(rollups.checkpoint_pieces(rows, "k", "key", "v", ["id"], size=100)), key=lambda r: (r["k"], r["piece"]))
    assert all(len(r["checkpoints"]) == r["n_keys"] <= 100 and min(r["checkpoints"]) == r["first_key"] for r in got)
    for k, values in want.items():
        own = [r for r in got if r["k"] == k]
        assert [r["piece"] for r in own] == list(range(-(-len(values) // 100)))
        assert [e for r in own for e in sorted(r["checkpoints"].items())] == sorted(values.items())
    assert rollups.checkpoint_pieces(rows.limit(0), "k", "key", "v", ["id"]).count() == 0
