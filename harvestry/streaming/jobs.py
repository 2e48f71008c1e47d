"""Queue, retry, status and upsert streams.

State that must survive between micro-batches lives in a batch log: one folder per batch id in the shared
file system, overwritten when a batch is run again, so a replay after a lost executor or driver changes nothing. Logs that
later batches read are folded into snapshots, so a batch reads one snapshot and a bounded number of logs.
Work on hot keys is split by the same range-based operators the batch jobs use.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.ledger import move_allowed
from harvestry.operators.ordering import group_ordinal, keep_last, with_previous
from harvestry.operators.rollups import FLAG_EFFECTS, flag_columns
from harvestry.specs import words


#: Batches after which a log that has a fold is folded into a snapshot.
FOLD_EVERY = 20


class BatchLog:
    """Table of micro-batch results under ``path/batch_id=N``, with snapshots under ``path/_folded/upto=N`` where it has a ``fold``.

    ``fold`` reduces rows (with ``batch_id``) to fewer rows that mean the same to every reader. When a batch starts, all batches before it are committed and
    never run again, so every ``every`` batches what came before is folded, written aside and published by one rename. A write that
    fails leaves nothing that readers see, and a replay finds the snapshot or writes it anew. A reader takes the newest snapshot before its batch and the logs
    after it. Logs and snapshots that the snapshot before the newest covers are deleted, so a job that still reads them has a whole period to end.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, fold: Callable[[DataFrame], DataFrame] | None = None, every: int | None = None):
        self.spark, self.path, self.schema, self.fold, self.every = spark, path, f"{schema}, batch_id bigint", fold, every or FOLD_EVERY

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    @property
    def _files(self):
        return self._path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        """Complete tables ``prefix=N`` of a folder."""
        path, files = self._path(folder), self._files
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{prefix}=") and files.exists(self._path(f"{folder}/{n}/_SUCCESS")))

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if self.fold is not None and batch_id and batch_id % self.every == 0:
            self.compact(batch_id - 1)

    def compact(self, upto: int) -> None:
        """Publish the snapshot of all batches up to ``upto``, which are committed, and delete what the snapshot before it covers."""
        folder = f"{self.path}/_folded"
        older = [n for n in self._numbers(folder, "upto") if n < upto]
        if upto not in self._numbers(folder, "upto"):
            aside = f"{self.path}/_aside-{uuid.uuid4().hex}"
            self.fold(self.read(upto + 1)).select(*self._empty().columns).write.parquet(aside)
            self._files.mkdirs(self._path(folder))
            self._files.rename(self._path(aside), self._path(f"{folder}/upto={upto}"))
        if older:
            for n in self._numbers(self.path, "batch_id"):
                if n <= older[-1]:
                    self._files.delete(self._path(f"{self.path}/batch_id={n}"), True)
            for n in older[:-1]:
                self._files.delete(self._path(f"{folder}/upto={n}"), True)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def read(self, before: int | None = None) -> DataFrame:
        """Rows of all batches, or of those before one batch: the newest snapshot and the logs after it."""
        snapshots = [n for n in self._numbers(f"{self.path}/_folded", "upto") if before is None or n < before] if self.fold else []
        newest = snapshots[-1] if snapshots else -1
        logs = [n for n in self._numbers(self.path, "batch_id") if n > newest and (before is None or n < before)]
        rows = self._empty()
        if snapshots:
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.path}/_folded/upto={newest}"))
        if logs:
            rows = rows.unionByName(self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f"{self.path}/batch_id={n}" for n in logs]))
        return rows


def run_to_end(writer) -> None:
    """Process everything that is available and stop."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def each_batch(stream: DataFrame, checkpoint: str, body: Callable[[DataFrame, int], None], mode: str = "append"):
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(body)


def frontier(urls: DataFrame, member: str, event_time: str | None = None, bound: str | None = None) -> DataFrame:
    """A member enters once. With a bound, state older than it is dropped (a member may then enter again after that long)."""
    if event_time and bound:
        timed = urls.withColumn(event_time, F.col(event_time).cast("timestamp"))
        return timed.withWatermark(event_time, bound).dropDuplicatesWithinWatermark([member])
    return urls.dropDuplicates([member])


def retry_batch(failures: DataFrame, url: str, order: Sequence[str], blocked: Column, prior: DataFrame, max_attempts: int) -> tuple[DataFrame, DataFrame]:
    """(decision per failure, counted failures per url of this batch). ``prior`` holds url and attempts so far.

    Blocked failures always go back and are never counted; others go back while the count is within the limit.
    """
    marked = failures.withColumn("_blocked", F.coalesce(blocked, F.lit(False)))
    free = marked.filter("_blocked").withColumns({"attempt": F.lit(None).cast("bigint"), "decision": F.lit("requeue_blocked")})
    counted = group_ordinal(marked.filter("NOT _blocked"), [url], order, "_nth")
    known = prior.groupBy(url).agg(F.sum("attempts").alias("_before"))
    attempt = F.col("_nth") + F.coalesce(F.col("_before"), F.lit(0))
    ruled = (counted.join(known, url, "left").withColumn("attempt", attempt)
             .withColumn("decision", F.when(F.col("attempt") <= max_attempts, "requeue").otherwise("dead_letter")))
    columns = [*failures.columns, "attempt", "decision"]
    counts = marked.filter("NOT _blocked").groupBy(url).agg(F.count("*").alias("attempts"))
    return ruled.select(columns).unionByName(free.select(columns)), counts


def stream_retry(failures: DataFrame, url: str, order: Sequence[str], blocked: Column, max_attempts: int, folder: str, schema: str):
    """Retry decisions as a batch log under ``folder/decisions``."""
    spark = failures.sparkSession
    total = lambda df: df.groupBy(url).agg(F.sum("attempts").alias("attempts"), F.max("batch_id").alias("batch_id"))
    counts = BatchLog(spark, f"{folder}/counts", f"{url} {dict(failures.dtypes)[url]}, attempts bigint", total)
    decisions = BatchLog(spark, f"{folder}/decisions", f"{schema}, attempt bigint, decision string")

    def body(batch: DataFrame, batch_id: int) -> None:
        ruled, added = retry_batch(batch, url, order, blocked, counts.read(batch_id), max_attempts)
        decisions.write(ruled, batch_id)
        counts.write(added, batch_id)

    return each_batch(failures, f"{folder}/progress", body), decisions


def stream_transitions(history: DataFrame, task: str, order: str, status: str, folder: str, moves: Sequence[tuple[str, str]] = words.ALLOWED_MOVES):
    """Violations as a batch log under ``folder/violations``; the last state per task is kept for the next batch."""
    spark = history.sparkSession
    kinds = dict(history.dtypes)
    state = BatchLog(spark, f"{folder}/state", f"{task} {kinds[task]}, {order} {kinds[order]}, {status} {kinds[status]}", lambda df: keep_last(df, [task], [order]))
    violations = BatchLog(spark, f"{folder}/violations", f"{task} {kinds[task]}, {order} {kinds[order]}, {status} {kinds[status]}, previous_status string")

    def body(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(task, order, status)
        linked = with_previous(rows, [task], [order], status, "_before")
        # Only a task's first row of the batch needs the state left by earlier batches.
        last = keep_last(state.read(batch_id).drop("batch_id"), [task], [order]).select(task, F.col(status).alias("_left"))
        open_rows = linked.filter(F.col("_before").isNull()).join(last, task, "left").select(*rows.columns, F.col("_left").alias("previous_status"))
        inner = linked.filter(F.col("_before").isNotNull()).withColumnRenamed("_before", "previous_status")
        seen = inner.unionByName(open_rows).filter(F.col("previous_status").isNotNull())
        violations.write(seen.filter(~move_allowed(F.col("previous_status"), F.col(status), moves)), batch_id)
        state.write(keep_last(rows, [task], [order]), batch_id)

    return each_batch(history, f"{folder}/progress", body), violations, state


def stream_upsert(records: DataFrame, key: Sequence[str], order: Sequence[str], folder: str, schema: str, route: Column | None = None):
    """Last write per key. Each batch adds its own winners; reading the log picks the last one over all batches."""
    log = BatchLog(records.sparkSession, f"{folder}/rows", schema, lambda df: keep_last(df, list(key), order))

    def body(batch: DataFrame, batch_id: int) -> None:
        tagged = batch if route is None else batch.withColumn("target", route)
        log.write(keep_last(tagged, list(key), order), batch_id)

    return each_batch(records, f"{folder}/progress", body), log


def monitor_flags(events: DataFrame, keys: Sequence[str], run: str, ts: str, kind: str, effects: Mapping = FLAG_EFFECTS) -> DataFrame:
    """Flags per run as a running aggregate for update mode."""
    return events.groupBy(*keys, run).agg(*flag_columns(F.col(kind), effects), F.max(ts).alias("flushed_at"))


def latest_values(events: DataFrame, task: str, key: str, value: str, order: str) -> DataFrame:
    """Latest value per (task, key) as a running aggregate for update mode."""
    return events.groupBy(task, key).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def stream_updates(aggregate: DataFrame, folder: str, schema: str, keys: Sequence[str] = ()):
    """Changed aggregate rows per batch as a batch log; with the aggregate's ``keys``, older states of a group are folded away."""
    log = BatchLog(aggregate.sparkSession, f"{folder}/rows", schema, (lambda df: keep_last(df, list(keys), ["batch_id"])) if keys else None)
    return each_batch(aggregate, f"{folder}/progress", log.write, mode="update"), log


def stage_output(stream: DataFrame, folder: str):
    """One stage's light messages as parquet, ready to be the next stage's input stream."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress")
