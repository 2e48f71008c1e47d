"""Readers. Input is always data that has already landed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions.jsonx import as_items, get_path, is_list, is_object
from harvestry.functions.text import is_blank, strip

RECORD_LISTS = ("records", "items", "data")


def _must(ok: Column, message: str) -> Column:
    """A condition that holds or fails the job; as a filter it stays even if no column is read."""
    return F.when(ok, True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def read_records(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """Records as VARIANT, one row each.

    ``.jsonl`` holds one object per line and splits over tasks; a line that is no object is an error.
    Other files hold one JSON value: an array of objects, or an object with a list under
    ``records``, ``items`` or ``data``. Empty input is an error.
    """
    lines = path.rstrip("/").endswith(".jsonl") if lines is None else lines
    text = spark.read.text(path, wholetext=not lines).filter(~is_blank(F.col("value")))
    if text.isEmpty():
        raise ValueError("input is empty")
    parsed = F.try_parse_json(strip(F.col("value")))
    if lines:
        return text.filter(_must(is_object(parsed), "line is not a JSON object")).select(parsed.alias("record"))
    lists = [get_path(parsed, k) for k in RECORD_LISTS]
    all_objects = lambda v: F.coalesce(F.size(as_items(v)) == F.size(F.try_variant_get(v, "$", "array<variant>")), F.lit(False))
    chosen = F.when(is_list(parsed), parsed).otherwise(F.coalesce(*[F.when(is_list(x) & all_objects(x), x) for x in lists]))
    checked = text.filter(_must(is_list(chosen) & all_objects(chosen), "no list of objects in the file"))
    return checked.select(chosen.alias("v")).select(F.explode(as_items(F.col("v"))).alias("record"))


def read_delimited(spark: SparkSession, path: str, encoding: str = "GB18030", schema: str | None = None) -> DataFrame:
    """CSV with a header; values stripped, null to '', columns without a name dropped."""
    if encoding.upper() in ("GB18030", "GBK"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = spark.read.option("header", True).option("encoding", encoding)
    raw = (reader.schema(schema) if schema else reader).csv(path)
    named = [c for c in raw.columns if c.strip() and not (c.startswith("_c") and c[2:].isdigit())]
    return raw.select(*[F.coalesce(strip(F.col(f"`{c}`")), F.lit("")).alias(c) for c in named])


def read_seed_lines(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line, as a set."""
    urls = spark.read.text(path).select(strip(F.col("value")).alias("url"))
    return urls.filter(F.col("url") != "").distinct()


def read_pages(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Landed responses; only the named columns are read."""
    pages = spark.read.parquet(path)
    return pages.select(*columns) if columns else pages


def stream_pages(spark: SparkSession, folder: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Landed responses as a stream of parquet files."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def union_sources(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Datasets stacked in order, each row tagged with dataset name, catalogue id and dataset order."""
    tagged = [df.withColumns({"dataset_name": F.lit(name), "catalog_id": F.lit(catalog), "dataset_order": F.lit(i)})
              for i, (name, (df, catalog)) in enumerate(sources.items())]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
