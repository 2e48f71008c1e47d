"""Set operations on member tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.session import written


def union_distinct(*members: DataFrame) -> DataFrame:
    """Members of any of the one-column tables, once."""
    out = members[0]
    for more in members[1:]:
        out = out.union(more)
    return out.distinct()


def except_done(df: DataFrame, done: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is not done yet, in order when one is given."""
    left = df.join(written(done.select(*keys).distinct(), "done"), list(keys), "left_anti")
    return left.orderBy(*order) if order else left


def ack(queue: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The queue as a set, without its processed members."""
    return except_done(queue.select(*keys).distinct(), processed, keys)


def concat_dedupe(*lists: Column) -> Column:
    """Lists one after another, first occurrences kept in order."""
    return F.array_distinct(F.concat(*lists))
