"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: lineage ends there, and later reads prune columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows that no model of this subpackage learns from: crc32 of the id as text, modulo 4, is 2. A null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def tidy(batches: Iterator[pa.RecordBatch], *memories: Callable[[], None]) -> Iterator[pa.RecordBatch]:
    """Pass batches on; at the end of the task forget ``memories`` and give unused buffers back, since Spark keeps its Python workers for other stages."""
    try:
        yield from batches
    finally:
        for forget in memories:
            forget()
        pa.default_memory_pool().release_unused()
