"""Folded batch logs, and streams against the same work done in one batch."""

import pytest
from pyspark.sql import functions as F

from harvestry.operators import ledger
from harvestry.operators.ordering import keep_last
from harvestry.session import scratch_path
from harvestry.streaming import jobs


def summed(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"), F.max("batch_id").alias("batch_id"))


def totals(df):
    return {r.k: r.n for r in df.groupBy("k").agg(F.sum("n").alias("n")).collect()}


def folders(log, spark):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(log.path)
    return [s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]


def test_a_folded_log_reads_like_the_whole_one(spark):
    log = jobs.BatchLog(spark, scratch_path(spark, "log"), "k string, n bigint", summed, every=3)
    assert totals(log.read()) == {} and totals(log.read(0)) == {}
    want = {}
    for batch in range(11):
        rows = [("hot", batch), (f"k{batch % 4}", 1)]
        for _ in range(2 if batch in (3, 6, 10) else 1):  # some batches run again, also those that fold
            assert totals(log.read(batch)) == want
            log.write(spark.createDataFrame(rows, "k string, n bigint"), batch)
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        assert totals(log.read()) == want
    logs = [f for f in folders(log, spark) if f.startswith("batch_id=")]
    assert len(logs) <= 2 * 3 + 1 and log._numbers(f"{log.path}/_folded", "upto") == [5, 8]


def test_a_fold_that_fails_leaves_the_log_as_it_was(spark):
    broken = {"on": True}

    def fold(df):
        if broken["on"]:
            raise RuntimeError("lost")
        return summed(df)

    log = jobs.BatchLog(spark, scratch_path(spark, "log"), "k string, n bigint", fold, every=2)
    one = spark.createDataFrame([("a", 1)], "k string, n bigint")
    log.write(one, 0)
    log.write(one, 1)
    with pytest.raises(RuntimeError):
        log.write(one, 2)
    half = f"{log.path}/_aside-x"
    one.withColumn("batch_id", F.lit(0)).write.parquet(half)  # what a lost driver leaves behind
    assert totals(log.read(2)) == {"a": 2} and totals(log.read()) == {"a": 3}
    broken["on"] = False
    log.write(one, 2)
    assert totals(log.read()) == {"a": 3} and log._numbers(f"{log.path}/_folded", "upto") == [1]


@pytest.fixture
def events(spark):
    """A hot task on a third of the rows, in ten files that arrive in order."""
    path = scratch_path(spark, "events")
    rows = spark.range(120).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("task"), F.col("id").alias("at"),
                                   F.element_at(F.array(*map(F.lit, ("pending", "queued", "running", "done", "waiting_retry"))), (F.col("id") * 7 % 5 + 1).cast("int")).alias("status"))
    for k in range(10):
        rows.filter(F.expr(f"at div 12 = {k}")).coalesce(1).write.mode("append").parquet(path)
    return rows, spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def same(a, b):
    assert sorted(map(tuple, a.select(*sorted(a.columns)).collect()), key=str) == sorted(map(tuple, b.select(*sorted(a.columns)).collect()), key=str)


def test_frontier_is_the_batch_answer(spark, events):
    rows, stream = events
    folder = scratch_path(spark, "frontier")
    jobs.run_to_end(jobs.stage_output(jobs.frontier(stream.select("task"), "task"), folder))
    same(spark.read.parquet(f"{folder}/out"), rows.select("task").distinct())


def test_transitions_are_the_batch_answer(spark, events, monkeypatch):
    monkeypatch.setattr(jobs, "FOLD_EVERY", 2)
    rows, stream = events
    writer, violations, state = jobs.stream_transitions(stream, "task", "at", "status", scratch_path(spark, "moves"))
    jobs.run_to_end(writer)
    same(violations.read().drop("batch_id"), ledger.transition_check(rows, "task", ["at"], "status"))
    same(keep_last(state.read().drop("batch_id"), ["task"], ["at"]), keep_last(rows, ["task"], ["at"]))
    assert state._numbers(f"{state.path}/_folded", "upto")


def test_monitor_is_the_batch_answer(spark, events, monkeypatch):
    monkeypatch.setattr(jobs, "FOLD_EVERY", 2)
    rows, stream = events
    shaped = lambda df: df.select("task", F.expr("at div 30").alias("run"), F.timestamp_seconds("at").alias("ts"), F.when(F.col("at") % 9 == 0, "list_failed").otherwise("has_content").alias("kind"))
    flags = lambda df: jobs.monitor_flags(df, ["task"], "run", "ts", "kind")
    schema = ", ".join(f"{n} {k}" for n, k in flags(shaped(rows)).dtypes)
    writer, log = jobs.stream_updates(flags(shaped(stream)), scratch_path(spark, "monitor"), schema, ["task", "run"])
    jobs.run_to_end(writer)
    same(keep_last(log.read(), ["task", "run"], ["batch_id"]).drop("batch_id"), flags(shaped(rows)))
