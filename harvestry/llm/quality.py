"""Quality score: histogram gradient-boosted trees over document statistics, flattened into arrays for numpy.

Statistics of each whole text are made once and kept in the shared folder. At most about ``MOST_ROWS`` labelled rows, chosen by a hash of
their id, train the trees (log loss, ``BINS`` quantile bins, complete trees of fixed depth). A tree of depth d is two arrays of 2^d - 1
features and thresholds and one of 2^d leaf values, so a batch walks all trees by index arithmetic.

Defined results: an empty or null text has statistics 0 and is scored by them. Rows are scored one by one, so repeated rows agree. Without
labelled rows of both classes every score is the smoothed share of label 1 (0.5 without any). Null ids are scored but have no label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import held_out, stored

MOST_ROWS, BINS, DEPTH, TREES, RATE, SHRINK = 20_000, 64, 4, 80, 0.15, 1.0
STATISTICS = 24


def _bytes(marks: str) -> list[int]:
    return list(marks.encode())


def statistics(text: str | None) -> list[float]:
    """Shares and means that describe the whole text's form; nothing of its meaning."""
    words = text.split() if text else []
    if not words:
        return [0.0] * STATISTICS
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    seen = np.bincount(raw, minlength=256)
    chars, n, lines = len(text), len(words), [x for x in text.split("\n") if x.strip()]
    upper, lower, digits = int(seen[65:91].sum()), int(seen[97:123].sum()), int(seen[48:58].sum())
    bare = [int(seen[_bytes(m)].sum()) / n for m in ("#", "*", "$", "%", "&", "|", "<>", "!", "?", ".", ",", ":;\"'()")]
    ends = sum(x.rstrip()[-1] in ".!?\"»" for x in lines)
    return [
        float(np.log1p(n)), chars / n, upper / (upper + lower + 1), digits / chars, *bare, int(seen[128:].sum()) / chars,
        len(set(words)) / n, sum(map(eq, words, words[1:])) / n, len(set(zip(words, words[1:]))) / n,
        ends / len(lines), 1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), sum(x[:1].islower() for x in lines) / len(lines),
    ]


@dataclass
class Trees:
    """Complete trees: ``feature`` and ``threshold`` by tree and inner node, ``leaf`` by tree and leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        total, line = np.full(len(rows), self.start), np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (rows[line, feature[node]] > threshold[node])
            total += leaf[node - len(feature)] if len(node) else 0.0
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Histogram boosting: per level one count of gradients by (node, feature, bin)."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Trees(np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), float(np.log(share / (1 - share))))
    if len(labels) < 2 or labels.min() == labels.max():
        return model
    columns = rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(columns)]
    binned = np.stack([np.searchsorted(e, rows[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    total, grown = np.full(len(labels), model.start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess, node = labels - p, p * (1 - p), np.zeros(len(labels), np.int64)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            width, base = 2**level, 2**level - 1
            at = (((node - base)[:, None] * columns + np.arange(columns)) * BINS + binned).ravel()
            g, h = (np.bincount(at, np.repeat(x, columns), width * columns * BINS).reshape(width, columns, BINS).cumsum(axis=2) for x in (grad, hess))
            gain = g**2 / (h + SHRINK) + (g[..., -1:] - g) ** 2 / (h[..., -1:] - h + SHRINK) - g[..., -1:] ** 2 / (h[..., -1:] + SHRINK)
            gain[(h < 1) | (h[..., -1:] - h < 1)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in np.flatnonzero(gain.reshape(width, -1).max(axis=1) > 1e-6):
                column, cut = divmod(int(best[k]), BINS)
                if cut < len(edges[column]):
                    feature[base + k], threshold[base + k] = column, edges[column][cut]
            node = 2 * node + 1 + (rows[np.arange(len(labels)), feature[node]] > threshold[node])
        node -= 2**depth - 1
        leaf = rate * np.bincount(node, grad, 2**depth) / (np.bincount(node, hess, 2**depth) + SHRINK)
        total += leaf[node]
        grown.append((feature, threshold, leaf))
    return Trees(*(np.stack(x) for x in zip(*grown)), model.start)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            found = [statistics(t) for t in part.column("text").to_pylist()]
            yield pa.record_batch([part.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "stats"])


def _score(batches: Iterator[pa.RecordBatch], model: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array(batch.column("stats").to_pylist(), float).reshape(batch.num_rows, STATISTICS)
        yield pa.record_batch([batch.column("doc_id"), pa.array(model.score(rows))], names=["doc_id", "score"])


def labelled(labels: DataFrame, column: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id, label`` of about ``most_rows`` rows that are not held out, or all if there are fewer."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    n = known.count()
    return known if n <= most_rows else known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most_rows / n))


def quality_scores(docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """Per row: ``doc_id, held_out, score``."""
    described = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_describe, "doc_id long, stats array<double>"), "statistics")
    # The sample is bounded, so it may be broadcast and come to the driver.
    sample = described.join(F.broadcast(labelled(labels, column)), "doc_id").select("label", "stats").collect()
    rows = np.array([r["stats"] for r in sample], float).reshape(len(sample), STATISTICS)
    model = fit(rows, np.array([r["label"] for r in sample], float))
    scored = described.mapInArrow(lambda b: _score(b, model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
