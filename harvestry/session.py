"""Session settings and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "harvestry", **conf: str) -> SparkSession:
    """Session with the settings the operators assume; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # GB18030 text files need the wider charset list.
        "spark.sql.legacy.javaCharsets": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare_checkpoints(spark: SparkSession) -> None:
    """Use the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session in one process (``local``) may go without: it gets a folder of its own. Elsewhere each executor would write to its own disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="harvestry-ckpt-"))


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows and partition layout stay fixed even when executors are lost."""
    prepare_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, for tables handed from one job to the next."""
    prepare_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder. A reduced lookup side is written before its join: its size is then known, and adaptive execution may cut
    a skewed partition of the other side, which it cannot where an aggregate stands between the shuffle and the join."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal few large splits over all cores, where the session asks for it by ``spark.harvestry.spread``; else ``df`` as it is.

    It shuffles whole rows, so it is for single unsplit files on one machine and off unless set.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.harvestry.spread", "false") != "true":
        return df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """Deal the narrow rows of ``df`` over several tasks per core, ahead of work that makes pages out of them.

    A small file is one split however many pages its rows become. Tables that have as many splits stay as they are.
    """
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
