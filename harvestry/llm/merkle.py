"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and for every row a witness that proves it.

Method: incremental witnesses. Nodes are appended in order to ``Tree``, which holds one open run a level. A witness is a chain of (run, place):
every leaf below an open run shares it, so a sibling that is appended later extends the partial witnesses of the whole open subtree at once,
and a full run closes into a node that is appended one level up.

Spark appends blocks of ``RUN ** DEPTH`` aligned leaves of one source side by side. The block roots are the appends of the next round, until one node a
source is left; then the sources' roots are appended likewise. On the way back every block gets the witness of its root once and
hands it to its own nodes, so no full witness of a row is ever stored: leaves are reduced to a proof digest and a folded root where they are made.

Order: rows are range-split by (source, id, digest), so a source with a third of all rows spans many tasks; only one row for each partition and source is
carried between them. Rows that agree in all of it are split by their place in the table and are interchangeable.

Defined results: a null value is hashed as ``-``, and a null id or source comes first. Repeated rows are leaves of their own. A source of one row has the leaf
as its root, one source has the dataset's root. An empty table gives an empty result. Rows without id are never tampered with. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import stored

#: Nodes of a run, and levels that one task builds of a block.
RUN, DEPTH = 16, 2
BLOCK = RUN**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Run:
    """Neighbouring nodes under one parent; ``above`` is the parent's place once the run is closed."""

    __slots__ = ("above", "digests")

    def __init__(self):
        self.digests: list[str] = []
        self.above: tuple[Run, int] | None = None


Place = tuple[Run, int]


class Tree:
    """Append-only tree with an open run a level."""

    def __init__(self):
        self.open: list[Run] = []

    def append(self, node: str, level: int = 0) -> Place:
        """Add a node; runs that it fills are closed. Returns the start of its witness."""
        if level == len(self.open):
            self.open.append(Run())
        run = self.open[level]
        run.digests.append(node)
        if len(run.digests) == RUN:
            self._close(level)
        return run, (len(run.digests) - 1)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], Run()
        run.above = self.append(digest(*run.digests), level + 1)

    def finish(self, levels: int) -> str:
        """Close what is open below ``levels`` and return the node there."""
        for level in range(levels):
            if self.open[level].digests:
                self._close(level)
        return self.open[levels].digests[0]


def witness(place: Place, levels: int) -> list[tuple[str, str]]:
    """Per level: the siblings on the left and on the right, joined."""
    steps = []
    for _ in range(levels):
        run, at = place
        steps.append(("".join(run.digests[:at]), "".join(run.digests[at + 1 :])))
        place = run.above
    return steps


def fold(node: str, steps: list[tuple[str, str]]) -> str:
    for left, right in steps:
        node = digest(left, node, right)
    return node


def levels_of(n: int) -> int:
    """Levels that a block builds of a source of ``n`` nodes: all of them, or its aligned share."""
    levels = 0
    while RUN**levels < n and levels < DEPTH:
        levels += 1
    return levels


def _hashed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of the row: every value as text, its length in bytes and a colon before it."""
    return F.sha2(F.concat(*(_hashed(fields[f]) for f in FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``key, doc_id, leaf, other``: ``other`` is the leaf of the row with A-Z of its text lower-cased where 5 divides the id's crc32, else null.

    ``key`` orders like the source with null first, and is never null.
    """
    own = {f: F.col(f) for f in FIELDS}
    tampered = own | {"text": F.translate(F.col("text").cast("string"), UPPER, LOWER)}
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(key.alias("key"), F.col("doc_id").cast("long"), leaf(own).alias("leaf"), F.when(picked, leaf(tampered)).alias("other"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place within ``key``, and ``n``, the number of the key's rows. ``order`` starts with ``key``."""
    salted = stored(rows.withColumn("salt", F.monotonically_increasing_id()), "unsorted")
    order = [F.asc_nulls_first(c) for c in (*order, "salt")]
    part = stored(salted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
                  .withColumn("pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).drop("salt"), "sorted")
    cells = part.groupBy("key", "part").agg(F.count("*").alias("rows"), F.min("pos").alias("first"))  # a row for each partition and key that meet
    whole = Window.partitionBy("key")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = cells.select("key", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    return stored(part.join(known, ["key", "part"]).withColumn("at", F.col("pos") + F.col("shift")).drop("part", "pos", "shift"), "placed")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (key, block) at a time, from batches sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            for row in batch.slice(at, 1000).to_pylist():
                if held and (row["key"], row["block"]) != (held[0]["key"], held[0]["block"]):
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def _grouped(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("key", "block").sortWithinPartitions("key", "block", "at")


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * len(names), kinds)], names=names)


HEADS = (["key", "at", "digest", "n"], [pa.string(), pa.int64(), pa.string(), pa.int64()])


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = []
    for rows in _blocks(batches):
        tree, n = Tree(), rows[0]["n"]
        for row in rows:
            tree.append(row["digest"])
        made.append((rows[0]["key"], rows[0]["block"], tree.finish(levels_of(n)), -(-n // BLOCK)))
        if len(made) == 1000:
            yield _batch(made, *HEADS)
            made = []
    yield _batch(made, *HEADS)


def rounds(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``(levels, roots)``: the nodes that each round appends, from ``nodes(key, at, digest, n)`` on; and ``key, digest, round`` of every key's root."""
    levels, roots = [nodes], None
    while True:
        blocks = levels[-1].select("key", F.floor(F.col("at") / BLOCK).cast("long").alias("block"), "at", "digest", "n")
        heads = stored(_grouped(blocks).mapInArrow(_heads, "key string, at long, digest string, n long"), "heads")
        own = heads.where("n = 1").select("key", "digest", F.lit(len(levels) - 1).alias("round"))
        roots = own if roots is None else roots.union(own)
        following = heads.where("n > 1")
        if following.isEmpty():
            return levels, roots
        levels.append(following)


STEPS = "array<struct<l:string,r:string>>"
STEP = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
WITNESSES = (["key", "at", "steps", "subroot"], [pa.string(), pa.int64(), STEP, pa.string()])


def _witnessed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[tuple[str, str]], list[dict], str | None]]:
    """Every node with the steps inside its block, and those of its block's root, which come in the block's first row (at -1)."""
    for rows in _blocks(batches):
        top, *rows = rows
        tree, levels = Tree(), levels_of(rows[0]["n"])
        places = [tree.append(row["digest"]) for row in rows]
        tree.finish(levels)
        for row, place in zip(rows, places):
            yield row, witness(place, levels), top["steps"], top["subroot"]


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = []
    for row, own, above, subroot in _witnessed(batches):
        made.append((row["key"], row["at"], [{"l": left, "r": right} for left, right in own] + above, subroot))
        if len(made) == 500:
            yield _batch(made, *WITNESSES)
            made = []
    yield _batch(made, *WITNESSES)


PROOFS = (["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"], [pa.int64(), *[pa.string()] * 5, pa.bool_()])


def _prove(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    made, held, joined, above = [], None, "", []
    for row, own, top, subroot in _witnessed(batches):
        if top is not held:  # one list a block
            held, above = top, [(s["l"], s["r"]) for s in top]
            joined = "".join(left + right for left, right in above)
        folded = fold(row["other"] or row["digest"], own + above)
        made.append((row["doc_id"], row["digest"], subroot, root, digest("".join(left + right for left, right in own), joined), folded, folded == root))
        if len(made) == 1000:
            yield _batch(made, *PROOFS)
            made = []
    yield _batch(made, *PROOFS)


def _with_heads(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes by block, each block led by its root's witness ``(key, at, steps, subroot)``."""
    blocks = nodes.withColumn("block", F.floor(F.col("at") / BLOCK).cast("long"))
    return _grouped(blocks.unionByName(above.withColumnRenamed("at", "block").withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True))


def _down(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Witnesses of the blocks of ``levels[0]``. ``tops(key, round, steps, subroot)`` are those of the keys' roots."""
    top = lambda r: tops.where(F.col("round") == r).select("key", F.lit(0).cast("long").alias("at"), "steps", "subroot")
    above = top(len(levels) - 1)
    for r in range(len(levels) - 1, 0, -1):
        grown = _with_heads(levels[r], above).mapInArrow(_extend, f"key string, at long, steps {STEPS}, subroot string")
        above = stored(grown.union(top(r - 1)), "witnesses")
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256``, and ``folded_root, verified`` of the tampered row, or of the row as it is."""
    rows = placed(leaves(docs).withColumnRenamed("leaf", "digest"), ["key", "doc_id", "digest"])
    levels, roots = rounds(rows.select("key", "at", "digest", "n"))
    sources = placed(roots.select(F.lit("").alias("key"), F.col("key").alias("source"), "digest", "round"), ["key", "source"])
    upper, last = rounds(sources.select("key", "at", "digest", "n"))
    found = last.first()
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    root = found["digest"]
    empty = F.array().cast(STEPS)
    heads = _down(upper, last.select("key", "round", empty.alias("steps"), F.lit(None).cast("string").alias("subroot")))
    wanted = _with_heads(sources.select("key", "at", "digest", "n"), heads).mapInArrow(_extend, f"key string, at long, steps {STEPS}, subroot string")
    tops = stored(wanted.drop("key", "subroot").join(sources.select("at", "source", "digest", "round"), "at").select(F.col("source").alias("key"), "round", "steps", F.col("digest").alias("subroot")), "tops")
    proved = _with_heads(rows, _down(levels, tops))
    return proved.mapInArrow(lambda b: _prove(b, root), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
