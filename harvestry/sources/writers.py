"""Writers: upsert, routing, snapshots, exports, patches and checked replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions.text import is_blank
from harvestry.operators.ordering import keep_last


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Updates replace whole rows by key or are added; the last update of a key wins. ``base`` holds one row per key."""
    last = keep_last(updates, list(key), order)
    return base.join(last.select(*key), list(key), "left_anti").unionByName(last.select(*base.columns))


def route(df: DataFrame, rules: Mapping[str, Column], target: str = "target", default: str = "other") -> DataFrame:
    """Tag each row with its target; write with ``partitionBy(target)``."""
    chain = F.when(F.lit(False), "")
    for name, rule in rules.items():
        chain = chain.when(rule, name)
    return df.withColumn(target, chain.otherwise(default))


def write_routed(df: DataFrame, path: str, target: str = "target") -> None:
    df.write.mode("errorifexists").partitionBy(target).parquet(path)


def snapshot_manifest(df: DataFrame, sources: Sequence[str], **meta: str) -> DataFrame:
    """One row about a snapshot: its metadata, sources and row count."""
    tags = [F.lit(v).alias(k) for k, v in meta.items()]
    return df.agg(F.count("*").alias("row_count")).select(*tags, F.lit(",".join(sources)).alias("sources"), "row_count")


def write_snapshot(df: DataFrame, path: str, sources: Sequence[str], **meta: str) -> None:
    """Rows as JSON lines under ``rows`` and the one-row manifest beside them."""
    df.write.mode("errorifexists").json(f"{path}/rows", ignoreNullFields=False)
    # Counted from what was written, so the manifest always describes the files.
    spark = df.sparkSession
    written = spark.read.schema(df.schema).json(f"{path}/rows")
    snapshot_manifest(written, sources, **meta).coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")


def export_table(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Fixed column order with display headers."""
    return df.select(*[F.col(c).alias(header) for c, header in layout.items()])


def write_export(df: DataFrame, path: str, layout: Mapping[str, str]) -> None:
    export_table(df, layout).write.mode("errorifexists").csv(path, header=True, emptyValue="")


def patch(base: DataFrame, patches: DataFrame, key: str, set_columns: Sequence[str] = (), fill_blank: Mapping[str, Sequence[str]] | None = None,
          unset: Sequence[str] = ()) -> DataFrame:
    """Matched rows only: set columns, fill columns whose value is one of the blank words, null the unset ones."""
    fill_blank = fill_blank or {}
    cols = [*set_columns, *fill_blank]
    joined = base.join(patches.select(key, *[F.col(c).alias(f"_p_{c}") for c in cols], F.lit(True).alias("_hit")), key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changes = {c: F.when(hit, F.col(f"_p_{c}")).otherwise(F.col(c)) for c in set_columns}
    for c, blanks in fill_blank.items():
        open_value = is_blank(F.col(c)) | F.trim(F.col(c)).isin(*blanks) if blanks else is_blank(F.col(c))
        changes[c] = F.when(hit & open_value, F.col(f"_p_{c}")).otherwise(F.col(c))
    for c in unset:
        changes[c] = F.when(hit, F.lit(None)).otherwise(F.col(c))
    return joined.withColumns(changes).select(*base.columns)


def rename_legacy(df: DataFrame, current: str, origin: str, legacy: str, helpers: Sequence[str] = ()) -> DataFrame:
    """The legacy column's value moves in, the old value stays as origin when none is kept yet, helper columns go."""
    new = F.trim(F.coalesce(F.col(legacy), F.lit("")))
    old = F.trim(F.coalesce(F.col(current), F.lit("")))
    move = new != ""
    keep = move & is_blank(F.col(origin)) & (old != "") & (old != new)
    return df.withColumns({origin: F.when(keep, old).otherwise(F.col(origin)),
                           current: F.when(move, new).otherwise(F.col(current))}).drop(legacy, *helpers)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def safe_replace(df: DataFrame, path: str, expected: int, backup: str | None = None, overwrite_temp: bool = False) -> int:
    """Write beside the target, compare the written count with the plan, then swap and keep the old data as a backup.

    A left-over temporary folder or an existing backup stops the job before anything is changed.
    """
    spark = df.sparkSession
    temp, backup = f"{path}__new", backup or f"{path}__backup"
    fs, target = _fs(spark, path)
    new, old = _fs(spark, temp)[1], _fs(spark, backup)[1]
    if fs.exists(new) and not overwrite_temp:
        raise RuntimeError(f"temporary target exists: {temp}")
    if fs.exists(old):
        raise RuntimeError(f"backup exists: {backup}")
    df.write.mode("overwrite" if overwrite_temp else "errorifexists").parquet(temp)
    written = spark.read.parquet(temp).count()
    if written != expected:
        raise RuntimeError(f"count check failed: expected {expected}, wrote {written}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise RuntimeError(f"could not move {path} to {backup}")
    if not fs.rename(new, target):
        if had and not fs.rename(old, target):
            raise RuntimeError(f"could not move {temp} to {path}; the old data is at {backup}")
        raise RuntimeError(f"could not move {temp} to {path}; the old data is back")
    return written


