"""Best-fit packing of tokenised documents into fixed-length sequences.

Method: vector best-fit. A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths). An
item's vector follows from its length alone, so the whole corpus is described by one count per length, at most ``capacity`` of them.
``plan_bins`` fills one sequence at a time by the best-scoring length (weighted dot product with the residual capacities, or smallest
residual norm) under every constraint and repeats that filling while its lengths last. Spark counts the lengths, ranks the pieces within
their length, and gives each rank its place; only the length counts reach the driver.

Defined results: a null or empty text is one piece that holds only the end mark. Every row is packed, so repeated rows and null ids are
packed as often as they occur. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.common import stored, tidy

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, shard int"
#: Ranks within a length are counted per shard, so that a frequent length spreads over this many tasks.
SHARDS = 4096
#: Words whose ids a Python worker remembers: two generations of this many, of which the unused older one goes.
REMEMBERED = 150_000
#: Texts of ASCII and Latin letters only: here the pre-tokenizer's classes are these, and lower-casing goes letter by letter.
PLAIN_TEXT = re.compile(r"[ -~\t\n\rÀ-ÖØ-öø-ÿ]*")
PLAIN_TOKEN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: White space of the tokenizer: that of Python without four control characters.
SPACE = re.compile("[^\\S\x1c-\x1f]+")


class Memory(dict):
    """Ids by word. Words met since the last turn of generations are kept, older ones move up when they are met again."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        if (ids := self.older.get(word)) is None:
            ids = self.encode(word)
        self[word] = ids
        return ids


class WordEncoder:
    """Token ids of a text as little-endian 32-bit bytes, word by word.

    The tokenizer drops white space and never joins over it, so a text's ids are its words' ids in a row and most words come from memory.
    Plain texts are cut further, into the pre-tokenizer's own pieces; other words go through the whole tokenizer once each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model, alphabet = self.tokenizer.model, {}
        for code in {*range(32, 127), *range(0xC0, 0x100)}:  # the byte-level letters of all characters of a plain text
            shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
            alphabet[code] = shown
        self.alphabet, self.pieces, self.words = alphabet, Memory(self._piece), Memory(self._word)

    def _piece(self, piece: str) -> bytes:
        return b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(piece if piece.isascii() else piece.translate(self.alphabet)))

    def _word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, PLAIN_TOKEN.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, filter(None, SPACE.split(text))))


_ENCODERS: dict[str, WordEncoder] = {}


def _forget() -> None:
    _ENCODERS.clear()


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, rows = batch.slice(at, 500), []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = _ENCODERS[path].encode(text) + end
                for start in range(0, len(ids) // 4, capacity):
                    own = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start // capacity, start, len(own) // 4, zlib.crc32(own), zlib.crc32(b"%d" % (start // capacity), (doc_id or 0) & 0xFFFFFFFF) % SHARDS))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "shard"])


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each document's ids and one ``end_id``."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda b: tidy(_cut(b, tokenizer, capacity, end_id), _forget), PIECES)


@dataclass
class Plan:
    """For pieces of ``length``, the ranks from ``first`` on: ``uses`` of them in each sequence from ``bin`` on, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    uses: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


def _fill(lengths, left, vectors, residual, weights, score) -> np.ndarray:
    """How many pieces of each length go into one sequence."""
    used = np.zeros(len(lengths), np.int64)
    top = int(np.flatnonzero(left)[-1])  # each filling starts with the longest piece that is left
    while top >= 0:
        used[top] += 1
        residual = residual - vectors[top]
        fits = (left > used) & (vectors <= residual + 1e-12).all(axis=1)
        if not fits.any():
            break
        at = np.flatnonzero(fits)
        if score == "dot":
            worth = vectors[at] @ (weights * residual)
        else:
            worth = -(weights * (residual - vectors[at]) ** 2).sum(axis=1)
        top = int(at[len(at) - 1 - np.argmax(worth[::-1])])
    return used


def plan_bins(counts: dict[int, int], capacity: int, max_docs: int | None = None, max_cost: int | None = None, weights=(1.0, 0.05, 0.1), score: str = "norm") -> Plan:
    """Vector best-fit over length counts. ``weights`` are those of tokens, documents and attention cost, each in shares of its capacity.

    Work depends on the number of distinct lengths, not on the number of pieces: a filling is repeated until one of its lengths runs short.
    """
    lengths = np.array(sorted(counts), np.int64)
    left = np.array([counts[int(n)] for n in lengths], np.int64)
    max_docs, max_cost = max_docs or capacity, max_cost or capacity**2
    vectors = np.stack([lengths / capacity, np.full(len(lengths), 1 / max_docs), lengths.astype(float) ** 2 / max_cost], axis=1) if len(lengths) else np.zeros((0, 3))
    if len(lengths) and (vectors > 1).any():
        raise ValueError("a piece exceeds a capacity on its own")
    given, rows, bins = np.zeros(len(lengths), np.int64), [], 0
    while left.any():
        used = _fill(lengths, left, vectors, np.ones(3), np.array(weights), score)
        own = np.flatnonzero(used)
        times, offset = int((left[own] // used[own]).min()), 0
        for k in own:
            rows.append((lengths[k], given[k], used[k], bins, offset))
            offset += int(used[k] * lengths[k])
        given[own] += used[own] * times
        left[own] -= used[own] * times
        bins += times
    rows.sort()
    return Plan(*(np.array(c, np.int64) for c in (zip(*rows) if rows else [[]] * 5)), bins)


def _place(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    key = plan.length * (1 << 48) + plan.first
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
        within = rank - plan.first[at]
        where = plan.bin[at] + within // plan.uses[at], plan.offset[at] + within % plan.uses[at] * length
        yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), *map(pa.array, where)],
                              names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, max_docs: int | None = None, max_cost: int | None = None) -> DataFrame:
    """Place of every piece: ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Both scores are planned and the one that needs fewer sequences is used. ``max_docs`` and ``max_cost`` bound each sequence further.
    """
    pieces = stored(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    cells = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    # One row per length and shard, whatever the corpus' size.
    before = cells.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = min((plan_bins(counts, capacity, max_docs, max_cost, score=s) for s in ("norm", "dot")), key=lambda p: p.bins)
    in_shard = Window.partitionBy("length", "shard").orderBy("doc_id", "piece")
    ranked = (pieces.withColumn("at", F.row_number().over(in_shard) - 1)
              .join(before.select("length", "shard", "before"), ["length", "shard"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.coalesce("before", F.lit(0)) + F.col("at")).cast("long").alias("rank")))
    return ranked.mapInArrow(lambda b: _place(b, plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
