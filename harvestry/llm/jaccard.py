"""Near duplicates: n-gram Jaccard self-join by rare-first prefix filtering, verified once per pair, and its connected components.

Method. A document's set holds the 64-bit hashes of its distinct word n-grams. Documents of the same set are one class and are joined as one.
* Order: n-grams are sorted by how rare their hash bucket is in the whole corpus (a table of ``BUCKETS`` counts), then by hash. Any total
  order that all documents share gives right results; a rare-first one gives short lists.
* Prefix filter: two sets of Jaccard similarity t share an n-gram among the first n - ceil(t n) + 1 of each.
* Length filter: t n1 <= n2. Positional filter: what stands after the shared places cannot make up the overlap.
* Suffix filter: sets are cut by hash into small parts, of which a bitmap tells the filled ones. The overlap is at most the number of parts that
  both fill, plus what shares a part with another in the one that has less of it.
* Verification: once per pair, on the full sets.

Large groups of near copies never become all their pairs. First, in each list of a prefix n-gram and length band, everyone is paired with
one leader only; verified links give components. Further rounds take other leaders, and some rows before each. Then only pairs of *different* components that
still share a prefix n-gram are verified, all of them, in blocks of bounded size. So every link either is in the result's components or joins two texts of one component already.

Components are found by large-star and small-star rounds on the links, with tables in the shared folder between them; no link or component
reaches the driver, which only sees the bucket counts and row counts.

Defined results: a document without words has an empty set, links with nothing and is its own component; fewer words than n make one n-gram
of the whole sequence. A null id is a row like others, with component null unless linked. Repeated rows each get their row. Texts whose 64-bit
set hashes collide would count as one class.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import stored, tidy

BUCKETS = 1 << 18
#: Rows of one n-gram's list that meet in one block.
BLOCK_ROWS = 4000
#: Sets that a task remembers; forgetting costs time only.
REMEMBERED = 150_000
#: Rows and bytes of text whose sets are made at once; a longer text is alone.
SLICE_ROWS, SLICE_BYTES = 300, 1 << 20
#: For each of the first rounds: leaders that a text may meet, and how many rows before its own in the list it meets as well.
STAR_ROUNDS = ((4, 0), (64, 6), (64, 8))
#: Bits of the map of wanted ids (8 MB).
MOST_BITS = 1 << 26
SIGNED = "sig long, n int, doc_id long, text_hash long, bucket int, docs long"


def _scramble(x: np.ndarray) -> np.ndarray:
    """Changes ``x`` itself; different numbers stay different."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    return x


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the UTF-8 texts that begin at ``starts`` of ``data``, and where words begin. A-Z are lower-cased, words end at U+0020,
    U+0009 to U+000D and the ends of texts; they are hashed 8 bytes at a time."""
    low = np.zeros(len(data) + 8, np.uint8)
    np.add(data, ((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5), out=low[:-8])
    solid = np.ones(len(data) + 1, bool)  # of the byte before each place, then of the one at it
    solid[1:] = (data != 32) & ((data - np.uint8(9)) >= 5)
    begins, ends = solid[1:].copy(), solid[1:].copy()
    begins[1:] &= ~solid[1:-1]
    ends[:-1] &= ~solid[2:]
    inner = starts[(starts > 0) & (starts < len(data))]
    begins[inner] = solid[inner + 1]
    ends[inner - 1] = solid[inner]
    begins, left = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    left -= begins
    eights = np.ndarray(len(data) + 1, "<u8", low, strides=(1,))
    hashes = left.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    hashes ^= eights[begins] & masks[np.minimum(left, 8)]
    hashes = _scramble(hashes * np.uint64(0x9E3779B97F4A7C15))
    more, at = np.flatnonzero(left > 8), 8
    while len(more):
        own = hashes[more] ^ (eights[begins[more] + at] & masks[np.minimum(left[more] - at, 8)])
        hashes[more] = _scramble(own * np.uint64(0x9E3779B97F4A7C15))
        at += 8
        more = more[left[more] > at]
    return hashes, begins


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of all of them if they are fewer."""
    size = min(size, len(hashes))
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[k : len(hashes) - size + 1 + k]
        _scramble(total)
    return total


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    fresh = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=fresh[1:])
    return hashes if fresh.all() else hashes[fresh]


def _sets_of(data: np.ndarray, places: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text; text k is ``data[places[k]:places[k + 1]]``."""
    hashes, begins = _word_hashes(data, places[:-1])
    firsts = np.searchsorted(begins, places).tolist()
    grams = _grams(hashes, size) if len(hashes) >= size else hashes
    sets = []
    for first, end in zip(firsts, firsts[1:]):
        if end - first >= size:
            sets.append(_distinct(grams[first : end - size + 1]))  # runs over the border of two texts are left out
        else:
            sets.append(_grams(hashes[first:end], size) if end > first else np.zeros(0, np.uint64))
    return sets


def _shingled(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the sets of their texts: some hundred rows, fewer of long texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).fill_null("")
        _, offsets, data = texts.buffers()
        places = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            end = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(places, places[at] + SLICE_BYTES, "right")) - 1))
            yield batch.slice(at, end - at), _sets_of(data[places[at] : places[end]], places[at : end + 1] - places[at], size)
            at = end


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of one text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return _sets_of(data, np.array([0, len(data)]), size)[0]


def _signature(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A row for each text, and at the end one for each bucket that its task met."""
    names, kinds = ["sig", "n", "doc_id", "text_hash", "bucket", "docs"], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    counts = np.zeros(BUCKETS, np.int64)
    for rows, sets in _shingled(batches, 1, size):
        np.add.at(counts, _bucket(np.concatenate(sets)), 1)
        n = len(sets)
        yield pa.record_batch([pa.array([_signature(own) for own in sets], pa.int64()), pa.array([len(own) for own in sets], pa.int32()), rows.column(0), rows.column(2),
                               pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=names)
    full = np.flatnonzero(counts)
    known = {"bucket": full, "docs": counts[full]}
    yield pa.record_batch([pa.array(known[c], k) if c in known else pa.nulls(len(full), k) for c, k in zip(names, kinds)], names=names)


def _rare_first(own: np.ndarray, common: np.ndarray, first: int) -> np.ndarray:
    """The ``first`` of a set by bucket count ``common``, then by hash: those up to the last one's leading bits, in one sort on them where they tell all apart."""
    key = (np.minimum(common, (1 << 24) - 1).astype(np.uint64) << np.uint64(40)) | (own >> np.uint64(24))
    near = np.flatnonzero(key <= np.partition(key, first - 1)[first - 1])
    own, common, key = own[near], common[near], key[near]
    order = np.argsort(key)
    key = key[order]
    if key[-1] >> np.uint64(40) >= (1 << 24) - 1 or (key[1:] == key[:-1]).any():
        order = np.lexsort((own, common))
    return own[order[:first]]


def _prefixes(batches: Iterator[pa.RecordBatch], shared, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    rarity, seen = shared.value, set()
    for _, sets in _shingled(batches, 1, size):
        tokens, sigs, sizes, firsts = [], [], [], []
        for own in sets:
            if not len(own) or (sig := _signature(own)) in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(sig)
            first = len(own) - -(-percent * len(own) // 100) + 1
            tokens.append(_rare_first(own, rarity[_bucket(own)], first))
            sigs.append(sig)
            sizes.append(len(own))
            firsts.append(first)
        if tokens:
            given = (np.repeat(np.array(sigs, np.int64), firsts), np.repeat(np.array(sizes, np.int32), firsts), np.concatenate([np.arange(k, dtype=np.int32) for k in firsts]))
            yield pa.record_batch([pa.array(np.concatenate(tokens).view(np.int64)), *(pa.array(c) for c in given)], names=["token", "sig", "n", "place"])


def _may_link(n1, p1, n2, p2, percent: int) -> np.ndarray:
    """Length and positional filter."""
    need = -(-percent * (n1.astype(np.int64) + n2) // (100 + percent))
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (np.minimum(n1 - p1, n2 - p2) >= need)


def _live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and set: those whose list has another set, each once."""
    held = None  # the last row, whose successor is not known yet, and whether the row before it shares its token
    names = ["token", "sig", "n", "place"]

    def give(columns, alive):
        return pa.record_batch([pa.array(c[alive].astype(k)) for c, k in zip(columns, (np.int64, np.int64, np.int32, np.int32))], names=names)

    for batch in batches:
        columns = [batch.column(k).to_numpy().astype(np.int64) for k in range(4)]
        if held is not None:
            columns = [np.concatenate([[h], c]) for h, c in zip(held[0], columns)]
        if not len(columns[0]):
            continue
        fresh = np.ones(len(columns[0]), bool)  # the same set comes from several tasks
        fresh[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        columns = [c[fresh] for c in columns]
        same = columns[0][1:] == columns[0][:-1]
        before = np.concatenate([[held is not None and held[1]], same])
        alive = before.copy()
        alive[:-1] |= same
        alive[-1] = False  # it waits
        held = [c[-1] for c in columns], bool(before[-1])
        if alive.any():
            yield give(columns, alive)
    if held is not None and held[1]:
        yield give([np.array([h]) for h in held[0]], np.array([True]))


def _stars(batches: Iterator[pa.RecordBatch], before: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, length band and turn: each with the first of its band and with some before it, if their components differ and the filters let them pass."""
    kept = np.zeros((0, 6), np.int64)  # the leader, then the last rows
    for batch in batches:
        fresh = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(6)], axis=1)  # token, band, sig, n, place, root
        if not len(fresh):
            continue
        rows, old = np.concatenate([kept, fresh]), len(kept)
        starts = np.ones(len(rows), bool)
        starts[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        first = np.maximum.accumulate(np.where(starts, np.arange(len(rows)), 0))
        own, found = np.arange(old, len(rows)), []
        for others in (first[own], *(own - k for k in range(1, before + 1))):
            mine, theirs = rows[own[others >= 0]], rows[others[others >= 0]]
            ok = (mine[:, :2] == theirs[:, :2]).all(axis=1) & (mine[:, 5] != theirs[:, 5]) & _may_link(theirs[:, 3], theirs[:, 4], mine[:, 3], mine[:, 4], percent)
            found.append(np.stack([np.minimum(mine[ok, 2], theirs[ok, 2]), np.maximum(mine[ok, 2], theirs[ok, 2])], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        last = len(rows) - 1
        kept = rows[[int(first[last]), *range(max(int(first[last]) + 1, last - before + 1, 0), last + 1)]]
        yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _cross(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within each block (token, low, high) that the filters let pass; rows come sorted by block."""
    kept = np.zeros((0, 8), np.int64)  # rows of the last block, which may go on
    for batch in batches:
        fresh = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(8)], axis=1)  # token, low, high, sig, n, place, root, part
        if not len(fresh):
            continue
        rows, old = np.concatenate([kept, fresh]), len(kept)
        starts = np.ones(len(rows), bool)
        starts[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        first = np.maximum.accumulate(np.where(starts, np.arange(len(rows)), 0))
        ahead = np.arange(old, len(rows)) - first[old:]  # rows of its block before each new row
        for own in np.split(np.arange(old, len(rows)), np.flatnonzero(np.diff(np.cumsum(ahead) // 1_000_000)) + 1):
            before = own - first[own]
            mine = np.repeat(own, before)
            theirs = np.arange(len(mine)) - np.repeat(np.cumsum(before) - before, before) + first[mine]
            ok = rows[mine, 6] != rows[theirs, 6]
            mine, theirs = mine[ok], theirs[ok]
            ok = _may_link(rows[mine, 4], rows[mine, 5], rows[theirs, 4], rows[theirs, 5], percent) & ((rows[mine, 1] == rows[mine, 2]) | (rows[mine, 7] != rows[theirs, 7]))
            x, y = rows[mine[ok], 3], rows[theirs[ok], 3]
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        kept = rows[first[-1] :]


def _map_of(own: np.ndarray) -> bytes:
    """Bitmap of 8 to 16 bits for each n-gram of a set."""
    bits = 1 << (8 * len(own)).bit_length()
    filled = np.zeros(bits, np.uint8)
    filled[(own % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(filled).tobytes()


def overlap_bound(x: np.ndarray, n1: int, y: np.ndarray, n2: int) -> int:
    """What two sets can share at most, by their packed bitmaps; the larger one is folded to the size of the smaller."""
    while len(x) != len(y):
        long = x if len(x) > len(y) else y
        half = long[: len(long) // 2] | long[len(long) // 2 :]
        x, y = (half, y) if long is x else (x, half)
    ones = lambda m: int(np.bitwise_count(m).sum())
    return ones(x & y) + min(n1 - ones(x), n2 - ones(y))


def _plausible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n1, one, n2, two in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist(), batch.column(5)):
            most = overlap_bound(np.frombuffer(one.as_buffer(), np.uint8), n1, np.frombuffer(two.as_buffer(), np.uint8), n2)
            keep.append((100 + percent) * most >= percent * (n1 + n2))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, two in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
            x, y = (x, y) if len(x) < len(y) else (y, x)
            shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    names, kinds = ["sig", "n", "hashes", "map"], (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    for _, sets in _shingled(batches, 1, size):
        found = [(_signature(own), len(own), own.tobytes(), _map_of(own)) for own in sets]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)


def _bits(keys: DataFrame) -> int:
    return min(MOST_BITS, 1 << max(10, (32 * keys.count()).bit_length()))


def _bitmap(keys: DataFrame, place: Column, bits: int):
    """Broadcast map of the places that ``keys`` have; its size is bounded by ``MOST_BITS``."""
    shown = np.zeros(bits // 64, np.uint64)
    words = keys.select(place.alias("p")).groupBy((F.col("p") / 64).cast("long").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("v"))
    for word, value in words.collect():
        shown[word] = np.int64(value).astype(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(shown)


def _sift(batches: Iterator[pa.RecordBatch], shared, there: bool) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is a place in the map, or is not."""
    for batch in batches:
        at = batch.column(batch.num_columns - 1).to_numpy()
        yield batch.filter(pa.array(((shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1) == there))


def _sieved(rows: DataFrame, key: str, wanted: DataFrame, then=None, schema: str | None = None) -> DataFrame:
    """Rows whose ``key`` is among those of ``wanted``, and few others; ``then`` goes on with them in the same Python worker. A full map lets more
    through, which then join with nothing."""
    bits = _bits(wanted)
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    map_ = _bitmap(wanted, place, bits)
    placed = rows.withColumn("_place", place)
    if then is None:
        return placed.mapInArrow(lambda b: _sift(b, map_, True), placed.schema).drop("_place")
    return placed.mapInArrow(lambda b: then(_sift(b, map_, True)), schema)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` of every node of the undirected ``links(a, b)``: large-star and small-star until nothing changes."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Hang neighbours on the smallest one of a neighbourhood: those above the node, or those below it and the node. ``least`` is written
        before it is joined, so that a node with very many links can be split."""
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        moved = both.join(least, "a").where("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return stored((moved if large else moved.union(least.select("a", F.col("m").alias("b")))).distinct(), "links")

    def settled(edges: DataFrame) -> bool:
        """Whether every node hangs on one root, and no root on another node."""
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
        known = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
        return known.where("ups > 1 or ups = 1 and n > 1").isEmpty()

    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    for _ in range(rounds):
        if settled(edges):
            break
        edges = star(star(edges, True), False)
    else:
        raise RuntimeError("components did not settle")
    own = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stored(own.union(own.select(F.col("root").alias("node"), "root")).distinct(), "roots")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """Set key, size, parts, id and text hash of every row, and the tasks' bucket counts (where ``bucket`` is not null)."""
    return stored(_texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(lambda b: tidy(_sign(b, size)), SIGNED), "signed")


def linked(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(signed, links)``: set key, size and id of every row; and verified links ``a, b`` between set keys that make up all components."""
    spark = docs.sparkSession
    texts, signed = _texts(docs), _signed(docs, size)
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in signed.where("bucket is not null").groupBy("bucket").agg(F.sum("docs")).collect():  # at most BUCKETS rows
        counts[bucket] = n
    rarity = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))
    prefixes = texts.mapInArrow(lambda b: tidy(_prefixes(b, rarity, size, percent)), "token long, sig long, n int, place int")
    live = stored(prefixes.repartition("token").sortWithinPartitions("token", "sig").mapInArrow(_live, "token long, sig long, n int, place int"), "live")
    rows = signed.where("bucket is null and n > 0")
    classes = stored(rows.groupBy("sig").agg(F.min("doc_id").alias("doc_id")), "classes")

    tested: list[DataFrame] = []
    links: list[DataFrame] = []

    def verify(pairs: DataFrame) -> None:
        """Keep the linked ones of ``pairs`` that are new; sets are made again from the texts of the classes' first rows."""
        if tested:
            pairs = pairs.join(functools.reduce(DataFrame.union, tested), ["a", "b"], "left_anti")
        tested.append(pairs := stored(pairs, "pairs"))
        wanted = stored(pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct().join(classes.select("sig", "doc_id"), "sig"), "wanted")
        made = _sieved(texts, "doc_id", wanted, lambda b: tidy(_sets(b, size)), "sig long, n int, hashes binary, map binary")
        sets = stored(made.dropDuplicates(["sig"]), "sets")
        one = pairs.join(sets.select(F.col("sig").alias("a"), F.col("n").alias("n1"), F.col("map").alias("x")), "a")
        both = one.join(sets.select(F.col("sig").alias("b"), F.col("n").alias("n2"), F.col("map").alias("y")), "b").select("a", "b", "n1", "x", "n2", "y")
        likely = stored(both.mapInArrow(lambda b: _plausible(b, percent), "a long, b long"), "likely")
        full = _sieved(sets.select("sig", "hashes"), "sig", likely.select(F.col("a").alias("sig")).union(likely.select("b")))
        one = likely.join(full.select(F.col("sig").alias("a"), F.col("hashes").alias("x")), "a")
        both = one.join(full.select(F.col("sig").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")
        links.append(stored(both.mapInArrow(lambda b: _verify(b, percent), "a long, b long"), "verified"))

    def rooted() -> DataFrame:
        """Live rows with their component so far, in lists that hold more than one."""
        known = live.withColumn("root", F.col("sig"))
        if links:
            roots = components(functools.reduce(DataFrame.union, links))
            known = live.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        known = stored(known, "placed")
        mixed = known.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count("*").alias("k")).where("r1 <> r2")
        return known.join(stored(mixed.select("token", F.ceil(F.col("k") / BLOCK_ROWS).cast("int").alias("blocks")), "mixed"), "token")

    band = F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("int")  # lengths of one band pass the length filter among themselves
    for number, (leaders, before) in enumerate(STAR_ROUNDS):
        # In each list the first by a hash leads; which hash depends on the list, so a text meets several leaders in a round.
        turn = F.xxhash64("sig", F.pmod("token", F.lit(leaders)), F.lit(number))
        stars = rooted().select("token", band.alias("band"), "sig", "n", "place", "root", turn.alias("turn"))
        verify(stars.repartition("token").sortWithinPartitions("token", "band", "turn").mapInArrow(lambda b, before=before: _stars(b, before, percent), "a long, b long").distinct())
    parted = rooted().withColumn("part", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    spread = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = spread.select("token", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "sig", "n", "place", "root", "part")
    verify(blocks.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high").mapInArrow(lambda b: _cross(b, percent), "a long, b long").distinct())
    return rows.union(signed.where("bucket is null and n = 0")).select("sig", "n", "doc_id", "text_hash"), functools.reduce(DataFrame.union, links)


def _rooted(signed: DataFrame, links: DataFrame) -> DataFrame:
    """``sig, root, doc_id, text_hash`` of each class; the latter two are its least row, null ids last."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_hash"))).alias("least")
    classes = signed.where("n > 0").groupBy("sig").agg(least)
    joined = classes.join(components(links).withColumnRenamed("node", "sig"), "sig", "left")
    return stored(joined.select("sig", F.coalesce("root", "sig").alias("root"), "least"), "rooted")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (smallest id of its component)."""
    signed, links = linked(docs, size, percent)
    rooted = _rooted(signed, links)
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = stored(rooted.join(stored(first, "first"), "root").select("sig", F.col("first.doc_id").alias("component_id")), "named")
    full = signed.where("n > 0").join(named, "sig").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return full.union(signed.where("n = 0").select("doc_id", F.lit(0).cast("long"), F.col("doc_id")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, unchanged: that of the smallest id. Rows without words all stay.

    Most rows are known to stay from a bitmap of the others; only rows that may go are shuffled and looked up.
    """
    signed, links = linked(docs, size, percent)
    rooted = _rooted(signed, links)
    first = stored(rooted.groupBy("root").agg(F.min("least").alias("first")), "first")
    staying = stored(rooted.join(first, "root").where("least <=> first").select("sig", F.col("first.doc_id").alias("k_id"), F.col("first.text_hash").alias("k_hash")), "staying")
    rows = stored(signed.where("n > 0").groupBy("sig", "doc_id", "text_hash").agg(F.count("*").alias("copies")), "rows")
    stays = F.coalesce(F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_hash") == F.col("k_hash")), F.lit(False))
    suspects = stored(rows.join(staying, "sig", "left").withColumn("_stays", stays).where("copies > 1 or not _stays")
                      .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_stays"), "suspects")
    marked = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    bits = _bits(suspects)
    map_ = _bitmap(suspects, F.pmod(F.xxhash64("_id", "_hash"), F.lit(bits)), bits)
    placed = marked.withColumn("_place", F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("_hash")), F.lit(bits)))
    known = placed.mapInArrow(lambda b: _sift(b, map_, False), placed.schema).select(*docs.columns)
    asked = placed.mapInArrow(lambda b: _sift(b, map_, True), placed.schema).drop("_place").withColumn("_id", F.col("doc_id").cast("long"))
    found = asked.alias("d").join(suspects.alias("s"), F.col("d._id").eqNullSafe(F.col("s._id")) & (F.col("d._hash") == F.col("s._hash")), "left")
    turn = F.row_number().over(Window.partitionBy("d._id", "d._hash").orderBy(F.lit(1)))
    kept = found.withColumn("_turn", turn).where("_stays is null or _stays and _turn = 1")
    return known.union(kept.select(*(F.col(f"d.{c}") for c in docs.columns)))
