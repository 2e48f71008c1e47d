"""Recursive structures held as parent tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.operators.ordering import keep_first
from harvestry.session import scratch_path


def flatten_tree(nodes: DataFrame, node: str, parent: str, order: str) -> DataFrame:
    """Every node below the roots once, with depth and a path of (order, node) that sorts in preorder.

    One join per level; each level is written to the shared folder, so lineage stays short and a lost executor costs one level. Trees may
    have any depth. A row whose node already stands on its own path (a cycle) is left out.
    """
    spark, folder = nodes.sparkSession, scratch_path(nodes.sparkSession, "tree")
    step = F.array(F.struct(F.col(order).alias("order"), F.col(node).alias("node")))
    level = nodes.filter(F.col(parent).isNull()).select(F.col(node), step.alias("path"), F.lit(0).alias("depth"))
    links, schema, written = nodes.filter(F.col(parent).isNotNull()).select(F.col(node), F.col(parent), step.alias("_step")), level.schema, []
    while True:
        written.append(f"{folder}/{len(written)}")
        level.write.parquet(written[-1])
        level = spark.read.schema(schema).parquet(written[-1])
        if level.isEmpty():
            break
        above = level.select(F.col(node).alias(parent), F.col("path").alias("_above"), "depth")
        below = links.join(above, parent).filter(~F.array_contains(F.col("_above")["node"], F.col(node)))
        level = below.select(node, F.concat("_above", "_step").alias("path"), (F.col("depth") + 1).alias("depth"))
    out = spark.read.schema(schema).parquet(*written)
    usable = out.filter(F.col(node).isNotNull() & (F.col(node).try_cast("bigint") > 0))
    return keep_first(usable, [node], ["path"])
