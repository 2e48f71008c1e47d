"""Name → (Spark query, DuckDB twin)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harvestry.session import dealt, spread

TEXT_TABLES = ("documents", "pages", "conversations")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FAMILIES = (
    "sources", "shaping", "joining", "rollups", "quality", "ordering", "text", "urls", "money", "nested", "pages", "records", "streams",
)


class Tables:
    """The given tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(table) if name in TEXT_TABLES else table

    def wide(self, name: str) -> DataFrame:
        """A table of narrow rows about to meet costly per-row work."""
        return dealt(getattr(self, name))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is its twin."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"harvestry.plans.{family}")
