"""Alignment of two tokenizers over the same texts, with corpus-wide counts of the id pairs that overlap.

Method: exact-text deduplication. Rows are grouped by their full text, so each distinct text is tokenised and aligned once and carries its number
of rows; pair counts are sums of these numbers, and the measures are joined back to the ids by the text's SHA-256.

* A is a byte-level BPE over a space and the text, B a piece BPE with byte fallback that adds the space itself. Both are compared as bytes.
* Neither tokenizer joins over a border between a character that is no white space and a space or line feed after it (no piece of B holds a space behind
  another character, or a line feed at all), so a text is cut there into units, each unit is aligned once per task and texts are put together from
  units. Texts with other white space, control characters or U+2581 are one unit each.
* Stored per distinct text are its measures and its distinct id pairs with their occurrences, not the text.
* Pair counts meet the texts in blocks of A ids of at most ``BLOCK_PAIRS`` pairs each, one broadcast a block; a block holds all pairs of its A ids, and so
  their highest counts. The number of pairs is bounded by the vocabularies, not by the corpus.

A hot text is one row after the map side of the grouping; ids of a hot text join one row, which adaptive execution copies to the splits of its side.

Defined results: null and empty texts, and texts whose tokens do not give back the text's bytes, have no tokens: zeros, and '' in place of a hash. They hold no pairs.
Repeated rows each count as a document. Ties for the highest count all count as best. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import scratch_path

#: Units that a worker remembers between slices of texts (some 300 bytes each); forgetting costs time only.
REMEMBERED = 300_000
#: Unknown units that are tokenised in one call.
TOGETHER = 10_000
#: Units of one text that are put together at a time.
LONG = 200_000
#: Pairs of one broadcast block, and of a task's running counts.
BLOCK_PAIRS, HELD_PAIRS = 1_000_000, 400_000
UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space other than space and line feed, control characters, and the sign that B shows for a space.
ODD = re.compile("[^\\S \n]|[\x00-\x09\x0b-\x1f\x7f▁]")
ALIGNED = "text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
KINDS = (pa.binary(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary())
#: A pair's code: the A id times this, and the B id.
B_IDS = 1 << 20


class Units:
    """Aligned units by number: tokens, groups and links of each, the codes of its overlapping id pairs, its groups as text."""

    def __init__(self):
        self.sizes, self.codes, self.groups = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), []  # sizes: n_a, n_b, n_groups, n_links

    def add(self, sizes: np.ndarray, codes: np.ndarray, groups: list[bytes]) -> range:
        self.sizes, self.codes = np.concatenate([self.sizes, sizes]), np.concatenate([self.codes, codes])
        self.groups += groups
        self.first = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        return range(len(self.groups) - len(groups), len(self.groups))

    def measure(self, text: np.ndarray) -> tuple:
        """``n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of a text, given as the numbers of its units."""
        sha = hashlib.sha256()
        for at in range(0, len(text), LONG):
            sha.update((b";" if at else b"") + b";".join([self.groups[k] for k in text[at : at + LONG].tolist()]))
        own, often = np.unique(text, return_counts=True)
        links = self.sizes[own, 3]
        starts = np.cumsum(links) - links
        place = np.arange(links.sum()) + np.repeat(self.first[own] - starts, links)
        pairs, at = np.unique(self.codes[place], return_inverse=True)
        times = np.bincount(at, np.repeat(often, links), len(pairs)).astype(np.uint32)
        return *(often @ self.sizes[own]).tolist(), sha.hexdigest(), pairs.tobytes(), times.tobytes()


class Aligner:
    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_sizes = np.zeros(self.a.get_vocab_size(), np.int64)
        for token, k in self.a.get_vocab().items():  # one character a byte
            self.a_sizes[k] = len(token)
        pieces = map(self.b.id_to_piece, range(self.b.vocab_size()))
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode() for k, piece in enumerate(pieces)]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        #: Ids as text, followed by what stands after them: in a group, and at the end of A's and of B's part of it.
        self.shown = np.array([b"%d%b" % (k, mark) for mark in (b",", b"|", b";") for k in range(max(len(self.a_sizes), len(self.b_sizes)))], object).reshape(3, -1)
        self.units, self.numbers = Units(), {}

    def align(self, units: list[str], b_ids: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]] | None:
        """Sizes, codes and groups of units that stand in a row; None if their bytes do not come back or a token reaches over a unit's end.

        B sees a line feed before them, which keeps it from adding a space; ``b_ids`` are its ids where that is not wanted.
        """
        text = "".join(units)
        a_ids = np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        b_ids = self.b.encode("\n" + text)[2:] if b_ids is None else b_ids
        a_ends, encoded = np.cumsum(self.a_sizes[a_ids]), text.encode()
        if b"".join(map(self.b_bytes.__getitem__, b_ids)) != encoded or a_ends[-1] != len(encoded):
            return None
        b_ids = np.array(b_ids, np.int64)
        b_ends = np.cumsum(self.b_sizes[b_ids])
        ends = np.cumsum([len(u.encode()) for u in units])
        both, common = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
        cuts = np.stack([np.searchsorted(x, ends, side="right") for x in (a_ends, b_ends, common, both)], axis=1)
        if (common[cuts[:, 2] - 1] != ends).any():
            return None
        codes = a_ids[np.searchsorted(a_ends, both)] * B_IDS + b_ids[np.searchsorted(b_ends, both)]  # between two ends lies one pair
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        pieces = np.concatenate([self.shown[(common[a_group] == a_ends).astype(int), a_ids], self.shown[2 * (common[b_group] == b_ends), b_ids]])
        pieces = pieces[np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")].tolist()
        steps = (cuts[:, 0] + cuts[:, 1]).tolist()
        return np.diff(cuts, axis=0, prepend=0), codes, [b"".join(pieces[low:high])[:-1] for low, high in zip([0, *steps], steps)]

    def learn(self, units: set[str]) -> None:
        """Number the units that are not known yet, many at once. A unit of white space only ends a text, so it is not put before others."""
        new = list(units - self.numbers.keys())
        inner = [u for u in new if not u.isspace()]
        for part in [inner[at : at + TOGETHER] for at in range(0, len(inner), TOGETHER)] + [[u] for u in new if u.isspace()]:
            if made := self.align(part):
                self.numbers.update(zip(part, self.units.add(*made)))
            else:
                for unit in part:
                    made = self.align([unit])
                    self.numbers[unit] = self.units.add(*made)[0] if made else -1

    def texts(self, texts: list[str | None]) -> Iterator[tuple | None]:
        """Measures of a slice of texts."""
        odd = [bool(t and ODD.search(t)) for t in texts]
        cut = [UNIT.findall(" " + t) if t and not whole else [] for t, whole in zip(texts, odd)]
        if len(self.numbers) > REMEMBERED:
            self.units, self.numbers = Units(), {}
        self.learn(set().union(*cut))
        for text, units, whole in zip(texts, cut, odd):
            if whole:
                own, made = Units(), self.align([" " + text], self.b.encode(text))
                yield own.measure(np.array(own.add(*made))) if made else None
            else:
                numbers = np.fromiter(map(self.numbers.__getitem__, units), np.int64, len(units))
                yield self.units.measure(numbers) if len(numbers) and numbers.min() >= 0 else None


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


NOTHING = (0, 0, 0, 0, "", b"", b"")


def _slices(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of so many rows and characters, or of one row."""
    for batch in batches:
        lengths, start, total = [len(t) if t else 0 for t in batch.column("text").to_pylist()], 0, 0
        for k, n in enumerate(lengths):
            if k > start and (k - start >= rows or total + n > size):
                yield batch.slice(start, k - start)
                start, total = k, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def _align(batches: Iterator[pa.RecordBatch], a_file: str, b_file: str) -> Iterator[pa.RecordBatch]:
    if (a_file, b_file) not in _ALIGNERS:
        _ALIGNERS[a_file, b_file] = Aligner(a_file, b_file)
    aligner = _ALIGNERS[a_file, b_file]
    for part in _slices(batches, 200, 2_000_000):
        measures = [m or NOTHING for m in aligner.texts(part.column("text").to_pylist())]
        columns = [pa.array(c, k) for c, k in zip(zip(*measures), KINDS[2:])]
        yield pa.record_batch([part.column("text_key").cast(pa.binary()), part.column("copies"), *columns], names=[f.split()[0] for f in ALIGNED.split(", ")])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running counts of a task's pairs, given out when they are many."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    give = lambda: pa.record_batch([pa.array(codes // B_IDS, pa.int32()), pa.array(codes % B_IDS, pa.int32()), pa.array(counts)], names=["a", "b", "docs"])
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            pairs, copies = batch.slice(at, 500).column("pairs").to_pylist(), batch.slice(at, 500).column("copies").to_numpy()
            fresh = np.frombuffer(b"".join(pairs), np.int64)
            weights = np.repeat(copies, [len(p) // 8 for p in pairs])
            both, place = np.unique(np.concatenate([codes, fresh]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, place, np.concatenate([counts, weights]))
            codes, counts = both, total
            if len(codes) > HELD_PAIRS:
                yield give()
                codes, counts = codes[:0], counts[:0]
    yield give()


def _judge(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Best links and sum of counts over the links whose A ids are in the block."""
    known, counts, best = shared.value
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            pairs = part.column("pairs").to_pylist()
            codes, times = np.frombuffer(b"".join(pairs), np.int64), np.frombuffer(b"".join(part.column("times").to_pylist()), np.uint32).astype(np.int64)
            place = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
            there = known[place] == codes if len(known) else np.zeros(len(codes), bool)
            sums = []
            for value in (best, counts):
                own = np.zeros(len(codes), np.int64)
                own[there] = value[place[there]] * times[there]
                ends = np.cumsum([len(p) // 8 for p in pairs])
                running = np.concatenate([[0], np.cumsum(own)])
                sums.append(running[ends] - running[np.concatenate([[0], ends[:-1]])])
            yield pa.record_batch([part.column("text_key"), *map(pa.array, sums)], names=["text_key", "n_best", "count_sum"])


def aligned_texts(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """One row per distinct text: its number of rows, measures, and distinct id pairs with their occurrences."""
    texts = docs.select(F.col("text").cast("string")).where("length(text) > 0").groupBy("text").agg(F.count("*").alias("copies"))
    keyed = texts.select("text", "copies", F.unhex(F.sha2("text", 256)).alias("text_key"))
    path = scratch_path(docs.sparkSession, "aligned")
    keyed.mapInArrow(lambda b: _align(b, a_file, b_file), ALIGNED).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(ALIGNED).parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, docs, best``: how many rows hold the ids linked, and whether that is the A id's highest count."""
    counts = aligned.select("pairs", "copies").mapInArrow(_count, "a int, b int, docs long").groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    path = scratch_path(aligned.sparkSession, "pairs")
    counts.write.parquet(path)
    counts = aligned.sparkSession.read.schema("a int, b int, docs long").parquet(path)
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    return counts.join(top, "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("best"))


def pair_blocks(counts: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs in blocks of whole A ids, each read by itself: codes in order, counts, and whether they are best."""
    sizes = counts.groupBy("a").agg(F.count("*").alias("n")).orderBy("a").collect()  # at most one row for each id of the vocabulary
    ranges, first, held = [], 0, 0
    for a, n in sizes:
        if held and held + n > BLOCK_PAIRS:
            ranges.append((first, a))
            first, held = a, 0
        held += n
    for low, high in [*ranges, (first, 1 << 30)]:
        rows = counts.where((F.col("a") >= low) & (F.col("a") < high)).select((F.col("a").cast("long") * B_IDS + F.col("b")).alias("code"), "docs", "best").toArrow()
        code, docs, best = (rows.column(k).to_numpy() for k in range(3))
        order = np.argsort(code)
        yield code[order], docs[order], best[order].astype(np.int64)


def align(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = aligned_texts(docs, a_file, b_file)
    held, context, judged = aligned.where("n_links > 0"), docs.sparkSession.sparkContext, None
    for block in pair_blocks(pair_counts(held)):
        shared = context.broadcast(block)
        own = held.select("text_key", "pairs", "times").mapInArrow(lambda b, shared=shared: _judge(b, shared), "text_key binary, n_best long, count_sum long")
        judged = own if judged is None else judged.union(own)
    sums = judged.groupBy("text_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measures = held.drop("copies", "pairs", "times").join(sums, "text_key")
    asked = docs.select(F.col("doc_id").cast("long"), F.unhex(F.sha2(F.col("text").cast("string"), 256)).alias("text_key"))
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return asked.join(measures, "text_key", "left").select("doc_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
