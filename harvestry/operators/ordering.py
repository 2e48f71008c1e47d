"""Order-dependent work that stays balanced when one key holds a third of the rows.

A plain ``Window.partitionBy(key)`` puts a whole key into one task, and an unpartitioned window the
whole table. Here rows are range-split on (key, order) instead, so a hot key spans several partitions,
and only one boundary row per partition is carried between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.text import CJK, any_contains
from harvestry.session import pinned

PART, POS = "_part", "_pos"


def range_sorted(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows globally sorted and pinned, with partition number and position inside it."""
    laid_out = pinned(df.repartitionByRange(*order).sortWithinPartitions(*order))
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return laid_out.withColumn(PART, F.spark_partition_id()).withColumn(POS, position)


def _earlier(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def global_ordinal(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """1-based position in the total order. ``order`` must be unique."""
    rows = range_sorted(df, order)
    # One row per partition: bounded by the partition count, not by the data.
    sizes = rows.groupBy(PART).agg(F.count("*").alias("_n"))
    offsets = sizes.select(PART, F.coalesce(F.sum("_n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0)).alias("_offset"))
    return (rows.join(F.broadcast(offsets), PART)
            .withColumn(name, F.col("_offset") + F.col(POS) + 1).drop(PART, POS, "_offset"))


def group_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """1-based position inside each key, in ``order`` (unique inside the key)."""
    rows = range_sorted(df, [*keys, *order])
    runs = rows.groupBy(PART, *keys).agg(F.min(POS).alias("_start"), F.count("*").alias("_n"))
    # A key has at most one run per partition, so this window is small even for a hot key.
    carried = runs.withColumn("_before", F.coalesce(F.sum("_n").over(_earlier(keys)), F.lit(0))).drop("_n")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys] + [F.col(f"r.{PART}") == F.col(f"c.{PART}")]
    joined = rows.alias("r").join(carried.alias("c"), same)
    ordinal = F.col(f"r.{POS}") - F.col("c._start") + F.col("c._before") + 1
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], ordinal.alias(name))


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str = "previous") -> DataFrame:
    """Value of ``column`` in the row before, inside the key; null on the key's first row."""
    rows = range_sorted(df, [*keys, *order]).withColumn("_item", F.struct(*keys, F.col(column).alias("_value")))
    inside = Window.partitionBy(PART).orderBy(POS)
    # Last row of every partition: the only row its right-hand neighbour needs.
    tails = rows.groupBy(PART).agg(F.max_by("_item", POS).alias("_tail"))
    shifted = tails.select(PART, F.lag("_tail").over(Window.orderBy(PART)).alias("_left"))
    linked = (rows.join(F.broadcast(shifted), PART, "left")
              .withColumn("_prev", F.coalesce(F.lag("_item").over(inside), F.col("_left"))))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(f"_prev.{k}").eqNullSafe(F.col(k))
    return linked.select(*df.columns, F.when(same_key, F.col("_prev._value")).alias(name))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], drop_blank: bool = False) -> DataFrame:
    """First row per key. An aggregate, so a hot key shrinks to one row per task before the shuffle."""
    return _keep(df, keys, order, F.min_by, drop_blank)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], drop_blank: bool = False) -> DataFrame:
    """Last row per key."""
    return _keep(df, keys, order, F.max_by, drop_blank)


def _keep(df, keys, order, chooser, drop_blank):
    if drop_blank:
        for k in keys:
            df = df.filter(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != ""))
    whole = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        chooser(whole, F.struct(*[F.col(o) for o in order])).alias("_row"))
    return best.select("_row.*")


def cap(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in order; 0 means no cap."""
    return df.orderBy(*order).limit(n) if n > 0 else df


def name_order(name: Column) -> list[Column]:
    """Sort keys: names that start with a digit last, non-Chinese after Chinese, then the text."""
    return [name.rlike(r"^\d").asc(), (~name.rlike(f"^[{CJK}]")).asc(), name.asc()]


def top_k(df: DataFrame, filters: Column, keywords: Sequence[str], place: Column, order: Sequence[Column], k: int) -> DataFrame:
    """Rows that pass the filters and whose place holds a keyword (any case), best ``k`` by ``order``."""
    near = any_contains(F.upper(place), [w.upper() for w in keywords]) if keywords else F.lit(True)
    return df.filter(filters & near).orderBy(*order).limit(k)


def stop_rule(pages: DataFrame, series: Sequence[str], page: str, rows: str, size: int, total: str | None = None) -> DataFrame:
    """Pages a paging loop would really read: up to the first empty page (excluded), short page or declared last page."""
    empty = F.min(F.when(F.col(rows) == 0, F.col(page))).alias("_empty")
    short = F.min(F.when(F.col(rows) < size, F.col(page))).alias("_short")
    last = (F.min(F.when(F.col(page) >= F.greatest(F.ceil(F.col(total) / F.lit(size)), F.lit(1)), F.col(page)))
            if total else F.max(F.lit(None).cast("bigint"))).alias("_last")
    stops = pages.groupBy(*series).agg(empty, short, last)
    bound = F.least(F.col("_empty") - 1, F.col("_short"), F.col("_last"))
    return (pages.join(stops, list(series)).filter(bound.isNull() | (F.col(page) <= bound))
            .filter(F.col(rows) > 0).drop("_empty", "_short", "_last"))
