"""Near duplicates by SimHash: 64-bit fingerprints, searched by BK-trees, and the connected components of the links.

Method: a BK-tree is a tree of distinct fingerprints whose children hang on the edge of their integer Hamming distance to the parent. A search with a
radius follows, from a node at distance d, only the edges from d - radius to d + radius, since the others cannot hold a match.

* Shards. If fingerprints differ in at most r of 64 bits, cut into blocks, then all but r blocks agree. Every choice of that many blocks is a table, and
  the fingerprints that agree in a table's blocks are a shard. Two that link share a shard in some table, so only trees of a fingerprint's own shards are searched.
  ``CUTS`` lists the cuts; more fingerprints take one with longer keys. Which one is used changes the speed, not the links.
* Large shards (one key may hold a third of all rows) are cut into parts by hash. Each part's tree goes to every part of its shard, the queries;
  each pair of parts is one block of bounded size for some task, so no shard is gathered in one task.
* Many small shards are built and searched as one forest, level by level, in numpy.
* Links. A task reduces the matches of a block to one link from each fingerprint to the first of its component in the block, so a large group never
  becomes all its pairs. Components are then found by star rounds over tables in the shared folder.

The trees are not broadcast whole: their number grows with the corpus. They are built in the tasks that the shard's rows are dealt to.

Defined results: a null text, or one without words, has fingerprint zero and links like any other; fewer words than a shingle make one shingle. Repeated
rows each get their row. Rows with null id link, and have the component's smallest id, null if it has none. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import stored
from harvestry.llm.jaccard import components

BITS = 64
#: Blocks that the bits are cut into, in order of key length. With radius r, keys are made of all blocks but r.
CUTS = (4, 5, 6, 7)
#: Fingerprints for each key from which a cut with longer keys is taken.
CROWDED = 8
#: Rows of a part of a shard.
PART_ROWS = 4096
#: Rows that a task links at a time, pairs of query and tree node that it may hold, and shingles that it hashes at a time.
HELD_ROWS, FRONTIER, SHINGLES = 50_000, 1_000_000, 100_000
#: For each byte, its eight bits from the lowest on.
BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BYTE_SHIFT = 256 * np.arange(8)


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """Bits that are set in over half the XXH64 of the word shingles; bytes.lower() changes A-Z alone, bytes.split() cuts at U+0020 and U+0009 to U+000D."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    spans, counts, hash_ = list(zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())), np.zeros(2048, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(spans), SHINGLES):
        hashes = np.array([hash_(joined[a:b], seed) for a, b in spans[at : at + SHINGLES]], "<u8")
        counts += np.bincount((hashes.view(np.uint8).reshape(-1, 8) + BYTE_SHIFT).ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ BIT_TABLE).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(spans), bitorder="little").tobytes(), "little")


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 300):
            part = batch.slice(at, 300)
            prints = np.array([fingerprint(t, size) for t in part.column(1).to_pylist()], np.uint64)
            yield pa.record_batch([part.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


class Forest:
    """BK-trees of many shards: ``shard`` (sorted) and ``value`` of the items, which are distinct within a shard. Item k is node k."""

    def __init__(self, shard: np.ndarray, value: np.ndarray):
        self.value = value
        self.shards, self.roots, self.sizes = np.unique(shard, return_index=True, return_counts=True)
        under = np.repeat(self.roots, self.sizes)  # the node that an item has come down to
        moving, edges = np.flatnonzero(under != np.arange(len(value))), []
        while len(moving):
            edge = under[moving] * (BITS + 1) + distance(value[moving], value[under[moving]])
            known, first, which = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(np.stack([known, moving[first]]))  # the first item of an edge becomes its node
            under[moving] = moving[first][which]
            moving = moving[under[moving] != moving]
        edges = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        order = np.argsort(edges[0])
        self.edges, self.child = edges[0][order], edges[1][order]

    def search(self, shard: np.ndarray, value: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Matches ``(query, node)`` of the queries in the trees of their shards, some at a time."""
        place = np.minimum(np.searchsorted(self.shards, shard), max(0, len(self.shards) - 1))
        asked = np.flatnonzero(self.shards[place] == shard) if len(self.shards) else np.zeros(0, np.int64)
        if not len(asked):
            return
        cuts = np.flatnonzero(np.diff(np.cumsum(self.sizes[place[asked]]) // FRONTIER)) + 1
        for query in np.split(asked, cuts):
            node = self.roots[place[query]]
            while len(query):
                apart = distance(value[query], self.value[node])
                near = apart <= radius
                yield query[near], node[near]
                low = np.searchsorted(self.edges, node * (BITS + 1) + np.maximum(apart - radius, 0))
                many = np.searchsorted(self.edges, node * (BITS + 1) + np.minimum(apart + radius, BITS), side="right") - low
                before = np.cumsum(many) - many
                query = np.repeat(query, many)
                node = self.child[np.arange(len(query)) + np.repeat(low - before, many)]


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int64)


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked items the smallest label of their component; a label is an item, whose own label is the same or smaller."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def _linked(columns: np.ndarray, radius: int) -> np.ndarray:
    """Links ``a, b`` of whole blocks; columns are block number, part, low, high, print."""
    block, part, low, high, value = columns
    value = value.astype(np.uint64)
    label = np.arange(len(value))
    tree, asks = np.flatnonzero(part == low), np.flatnonzero(part == high)
    forest = Forest(block[tree], value[tree])
    for query, node in forest.search(block[asks], value[asks], radius):
        _settle(label, asks[query], tree[node])
    rest = np.flatnonzero(label != np.arange(len(label)))
    return np.stack([value[rest].view(np.int64), value[label[rest]].view(np.int64)])


def _link(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block (bits, key, low, high)."""
    held = np.zeros((6, 0), np.int64)

    def give(rows: np.ndarray) -> pa.RecordBatch:
        fresh = (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)
        a, b = _linked(np.stack([np.concatenate([[0], np.cumsum(fresh)]), rows[4], rows[2], rows[3], rows[5]]), radius)
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held = np.concatenate([held, np.stack([batch.column(k).to_numpy() for k in range(6)])], axis=1)
        if held.shape[1] < HELD_ROWS:
            continue
        last = np.flatnonzero((held[:4] != held[:4, -1:]).any(axis=0))  # the block of the last row may go on
        if len(last):
            yield give(held[:, : last[-1] + 1])
            held = held[:, last[-1] + 1 :]
    if held.shape[1]:
        yield give(held)


def tables(radius: int, prints: int) -> list[int]:
    """Bit masks of the tables' keys, for so many distinct fingerprints."""
    cuts = [c for c in CUTS if c > radius] or [radius + 1]
    for blocks in cuts:
        edges = [BITS * k // blocks for k in range(blocks + 1)]
        masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
        keys = [sum(chosen) for chosen in combinations(masks, blocks - radius)]
        if prints <= CROWDED << min(k.bit_count() for k in keys):
            break
    return keys


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``print``) that make up all components of those at most ``radius`` bits apart."""
    masks = [m - (1 << 64) if m >> 63 else m for m in tables(radius, prints.count())]
    keyed = prints.select("print", F.explode(F.array(*(F.struct(F.lit(m).cast("long").alias("bits"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("key")) for m in masks))).alias("t")).select("t.*", "print")
    large = stored(keyed.groupBy("bits", "key").agg(F.count("*").alias("n")).where(F.col("n") > PART_ROWS), "large")
    parts = F.coalesce(F.ceil(F.col("n") / PART_ROWS), F.lit(1)).cast("int")
    dealt = keyed.join(large, ["bits", "key"], "left").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("print"), F.col("parts")))
    others = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = others.select("bits", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "print")
    sorted_ = blocks.repartition("bits", "key", "low", "high").sortWithinPartitions("bits", "key", "low", "high", "print")
    return stored(sorted_.mapInArrow(lambda b: _link(b, radius), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """Per row: ``doc_id, fingerprint, component_id`` (smallest id of its component)."""
    signed = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda b: _sign(b, size), "doc_id long, print long"), "signed")
    prints = stored(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    rooted = prints.join(components(links(prints, radius)).withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(stored(least, "least"), "root").select("print", "component_id"), "named")
    return signed.join(named, "print").select("doc_id", shown(F.col("print")).alias("fingerprint"), "component_id")


def shown(value: Column) -> Column:
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
