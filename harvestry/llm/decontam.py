"""Benchmark decontamination with suffix arrays over shards of the training text.

Method: every Arrow batch of documents is a shard. Its word suffixes are sorted (a suffix array, to the depth that a window needs), every
test suffix is binary-searched in it, and the ranges found give all verbatim occurrences with their places. Suffixes whose first words start
no test suffix cannot be found and are left out before the sort. Neighbouring occurrences of the same item make up the longest match.

The test items travel in blocks of bounded size (``BLOCK_CHARS``), one broadcast each; every block is searched in every shard, so the work
is a stated query set against all rows. No row leaves its shard until it is reduced to counts and places.

Defined results: a null or empty text has no words and is clean; so is every text if there are no items. Items without words match
nothing; a null item id reads ''. Items that share an id count once. Repeated rows each get their row. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import tidy

WINDOW = 10
#: Characters of test items in one broadcast; a longer single item makes a block of its own.
BLOCK_CHARS = 4_000_000
#: Documents and bytes of a shard; a longer document is a shard of its own.
SHARD_DOCS, SHARD_BYTES = 4000, 4_000_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Word ids take 21 bits, three to a sort key; four keys hold a window and two words more.
BITS, KEYS = 21, 4
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
FOUND = "doc_id long, text_hash long, block int, n_words long, places array<int>, items array<string>, longest long, longest_at long"


def words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8: bytes.lower() changes A-Z alone, and all bytes of other letters are over 0x7F."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class TestBlock:
    """The windows of a block of items, as sorted keys, and where each window stands."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], number: int, window: int = WINDOW):
        self.number, self.vocabulary = number, {}
        places: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        self.names = [name for name, _ in items]
        for k, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                places[tuple(ids[at : at + window])].append((k, at))
        if len(self.vocabulary) >= 1 << BITS:
            raise ValueError("too many words in one block of test items")
        self.windows = list(places)
        self.places = [places[w] for w in self.windows]
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        low, high = (np.array([w + (pad,) * (3 * KEYS - len(w)) for w in self.windows], np.int64).reshape(-1, 3 * KEYS) for pad in (0, (1 << BITS) - 1))
        self.low, self.high = _pack(low), _pack(high)
        self.starts = []  # for windows of one word, of two, and of three or more: the hashed first words
        for n in (1, 2, 3):
            own = low[np.minimum(self.lengths, 3) == n][:, :n]
            table = np.zeros(1 << 20, bool)
            table[_mixed([own[:, j] for j in range(n)])] = True
            self.starts.append(table if len(own) else None)


def _pack(ids: np.ndarray) -> np.ndarray:
    return np.stack([(ids[:, 3 * k] << 2 * BITS) | (ids[:, 3 * k + 1] << BITS) | ids[:, 3 * k + 2] for k in range(KEYS)], axis=1)


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(columns[0]), np.uint64)
    for column, mixer in zip(columns, MIXERS):
        total += column.astype(np.uint64) * mixer
    return (total >> np.uint64(44)).astype(np.int64)


def _bounds(keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all rows of ``wanted`` in the sorted rows of ``keys``."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys), np.int64)
    while (open_ := low < high).any():
        middle = np.where(open_, (low + high) // 2, 0)
        below, same = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
        for k in range(KEYS):
            mine = keys[middle, k] if len(keys) else middle
            below |= same & (mine < wanted[:, k])
            same &= mine == wanted[:, k]
        right = open_ & (below | same if after else below)
        low, high = np.where(right, middle + 1, low), np.where(open_ & ~right, middle, high)
    return low


def numbered(texts: list[str | None], block: TestBlock) -> list[np.ndarray]:
    """Each text's words as ids of the block's vocabulary, 0 for others; the words of one text are held at a time."""
    know = block.vocabulary.get
    return [np.array([know(w, 0) for w in words(t)], np.int32) for t in texts]


def find(texts: list[np.ndarray], block: TestBlock) -> dict[int, tuple[np.ndarray, set[int], int, int]]:
    """By document of the shard: hit word places, items found, length and place of the longest match."""
    if not block.windows:
        return {}
    sizes = np.array([len(t) + 1 for t in texts], np.int64)  # one empty word ends each document
    first = np.cumsum(sizes) - sizes
    ids = np.zeros(int(sizes.sum()) + 3 * KEYS, np.int64)
    for at, text in zip(first, texts):
        ids[at : at + len(text)] = text
    n = len(ids) - 3 * KEYS
    may = np.zeros(n, bool)
    for k, table in enumerate(block.starts):
        if table is not None:
            may |= table[_mixed([ids[j : n + j] for j in range(k + 1)])]
    suffixes = np.flatnonzero(may & (ids[:n] > 0))
    keys = _pack(ids[suffixes[:, None] + np.arange(3 * KEYS)]) if len(suffixes) else np.zeros((0, KEYS), np.int64)
    order = np.lexsort(keys.T[::-1])
    suffixes, keys = suffixes[order], keys[order]
    low, high = _bounds(keys, block.low, False), _bounds(keys, block.high, True)
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for w in np.flatnonzero(high > low):
        at = np.sort(suffixes[low[w] : high[w]])
        for doc, place in zip(np.searchsorted(first, at, side="right") - 1, at):
            found[int(doc)].append((int(place - first[doc]), int(w)))
    out = {}
    for doc, hits in found.items():
        edges = np.zeros(int(sizes[doc]) + 1, np.int64)
        lines: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)  # by item and shift: spans in the document
        for place, w in hits:
            edges[place] += 1
            edges[place + block.lengths[w]] -= 1
            for item, at in block.places[w]:
                lines[item, place - at].append((place, place + int(block.lengths[w])))
        best = (0, 0)
        for spans in lines.values():
            begin = end = None
            for a, b in sorted(spans):
                begin, end = (a, b) if end is None or a > end - WINDOW + 1 else (begin, b)
                best = max(best, (end - begin, -begin))
        out[doc] = np.flatnonzero(np.cumsum(edges) > 0), {item for item, _ in lines}, best[0], -best[1]
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, sizes = 0, np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        while at < batch.num_rows:
            start = sizes[at - 1] if at else 0
            stop = max(at + 1, min(at + SHARD_DOCS, int(np.searchsorted(sizes, start + SHARD_BYTES, side="right"))))
            yield batch.slice(at, stop - at)
            at = stop


def _search(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    block: TestBlock = shared.value
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.int64())
    for shard in _shards(batches):
        texts = numbered(shard.column("text").to_pylist(), block)
        found = find(texts, block)
        rows = []
        for k, (doc_id, text_hash) in enumerate(zip(shard.column("doc_id").to_pylist(), shard.column("text_hash").to_pylist())):
            if k in found or block.number == 0:  # the first block counts the rows, the others only add what they find
                places, items, longest, at = found.get(k, ((), (), 0, 0))
                rows.append((doc_id, text_hash, block.number, len(texts[k]), list(places), sorted(block.names[i] for i in items), longest, at))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 8, kinds)], names=["doc_id", "text_hash", "block", "n_words", "places", "items", "longest", "longest_at"])


def test_blocks(items: DataFrame) -> list[TestBlock]:
    """The test items in blocks of at most ``BLOCK_CHARS`` characters, or of one item; each block is read by itself."""
    narrow = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string")).where("length(text) > 0")
    total = narrow.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-2 * total // BLOCK_CHARS))
    while parts > 1:  # until chance has put no more than the bound into each
        placed = narrow.groupBy(F.pmod(F.xxhash64("item", "text"), F.lit(parts)).alias("part")).agg(F.sum(F.length("text")).alias("n"), F.countDistinct("item", "text").alias("k"))
        if not placed.where((F.col("n") > BLOCK_CHARS) & (F.col("k") > 1)).head(1):
            break
        parts *= 2
    chosen = lambda k: narrow.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k).distinct()
    return [TestBlock([tuple(r) for r in chosen(k).collect()], k) for k in range(parts)]


test_blocks.__test__ = False


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, places`` (of hit words), ``items``, and the longest verbatim match (words, and its place)."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("text_hash", F.xxhash64("text"))
    context, found = docs.sparkSession.sparkContext, None
    for block in test_blocks(items):
        shared = context.broadcast(block)
        own = narrow.mapInArrow(lambda b, shared=shared: tidy(_search(b, shared)), FOUND)
        found = own if found is None else found.unionByName(own)
    # Rows of one id and text are alike, so they may meet; the first block says how many there are.
    joined = found.groupBy("doc_id", "text_hash").agg(
        F.sum(F.expr("int(block = 0)")).cast("int").alias("copies"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max(F.struct("longest", "longest_at")).alias("best"))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "n_words", "places", "items", "best.longest", "best.longest_at")


def _clean(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for shard in _shards(batches):
        found = find(numbered(shard.column("text").to_pylist(), shared.value), shared.value)
        yield shard.filter(pa.array([k not in found for k in range(shard.num_rows)], pa.bool_()))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no window of any item occurs; ``text`` must be a string column."""
    context = docs.sparkSession.sparkContext
    for block in test_blocks(items):
        shared = context.broadcast(block)
        docs = docs.mapInArrow(lambda b, shared=shared: tidy(_clean(b, shared)), docs.schema)
    return docs
