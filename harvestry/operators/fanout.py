"""One input row to several records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import collapse, norm_text


def fan_out_results(records: DataFrame, items: str, overrides: Mapping[str, str], mode: str = "all") -> DataFrame:
    """One output per result item with the base copied and the item's non-empty values on top; no items gives the base row.

    ``mode='first'`` keeps the first item only.
    """
    base = records.drop(items)
    listed = F.col(items) if mode == "all" else F.slice(F.col(items), 1, 1)
    opened = records.select(*base.columns, F.posexplode_outer(listed).alias("item_no", "_item"))
    changes = {}
    for target, field in overrides.items():
        value = norm_text(F.col(f"_item.{field}"), entities=False)
        changes[target] = F.when(value != "", value).otherwise(F.col(target))
    return opened.withColumns(changes).drop("_item")


def explode_participants(resources: DataFrame, people: str, person_id: Sequence[str], fields: Mapping[str, Sequence[str]], context: Sequence[str]) -> DataFrame:
    """Resource → its people: aliases per field, id '' or '0' dropped, resource context copied down."""
    def first(names: Sequence[str]) -> Column:
        picks = [F.when(collapse(F.col(f"_p.{n}").cast("string")) != "", collapse(F.col(f"_p.{n}").cast("string"))) for n in names]
        return F.coalesce(*picks, F.lit(""))

    opened = resources.select(*context, F.explode(people).alias("_p"))
    out = opened.select(*context, first(person_id).alias("person_id"), *[first(names).alias(n) for n, names in fields.items()])
    return out.filter(~F.col("person_id").isin("", "0"))
