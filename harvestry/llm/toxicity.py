"""Toxicity score: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length, with exception phrases.

Folding lower-cases, replaces letters that look like Latin ones, reads digits and signs before a letter as the letters they stand for
(``1d10t``), and makes everything else a space. The lexicon is learned from at most about ``MOST_ROWS`` labelled rows: words, and word
beginnings, whose document frequency is higher under label 1 by more than chance among so many terms explains; the weight is the smoothed
log odds ratio. Exception phrases are patterns of the same automaton; what they cover does not count. The score is a logistic function of
the weight per 100 words and of the number of hits.

Counting is a Spark aggregation; only the lexicon of at most ``MOST_TERMS`` and the features of the labelled sample reach the driver.

Defined results: an empty or null text has no hits and the lowest score. Without labelled rows of both classes the lexicon is empty and every
score is the smoothed share of label 1 (0.5 without any). Repeated rows agree; null ids are scored but have no label. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import held_out, stored, tidy
from harvestry.llm.quality import labelled

MOST_ROWS, MOST_TERMS, LEAST_DOCS, LEAST_WEIGHT, SURPRISE, STEMS = 20_000, 20_000, 4, 2.0, 0.75, range(4, 7)
#: Terms whose counts a task holds before it gives them out.
HELD_TERMS = 200_000

# Look-alikes of Latin letters, digits and signs that stand for letters, and harmless phrases.
LOOKALIKES = dict(zip("аеорсухіјѕԁһӏԛԝвкмнтαορυνικτεɑɡ", "aeopcyxijsdhlqwbkmhtaopuvikteag"))
STANDS_FOR = dict(zip("0134578@$!|", "oieastbasil"))
EXCEPTIONS = ("idiot proof", "idiot s guide", "trash can", "trash bin", "trash bag", "class clown", "clown fish", "pathetic fallacy", "loser bracket", "scum line", "pond scum")

DISGUISE = re.compile(r"(?<![^\W_])[0134578@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")


class _Folding(dict):
    """str.translate table: letters stay, look-alikes change, all else is a space."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        got = self[code] = LOOKALIKES.get(c) or (c if c.isalpha() else " ")
        return got


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    low = (text or "").lower()
    if DISGUISE.search(low):
        low = DISGUISE.sub(lambda m: "".join(STANDS_FOR[c] for c in m[0]), low)
    return f" {low.translate(_FOLDING)} "


def terms(text: str | None) -> set[str]:
    """What may enter the lexicon: words, marked by spaces on both sides, and their beginnings, by one before."""
    words = set(fold(text).split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in STEMS if len(w) > k}


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(term := f" {phrase} ", (len(term), None))
        if len(found):
            found.make_automaton()
        return found

    def features(self, text: str | None, automaton) -> tuple[float, float]:
        """Log weight per 100 words, and log number of hits. Of terms that start together only the heaviest counts."""
        folded, hits, spared = fold(text), {}, []
        if len(automaton):
            for end, (size, weight) in automaton.iter(folded):
                if weight is None:
                    spared.append((end - size + 1, end))
                else:
                    hits[end - size + 1] = max(weight, hits.get(end - size + 1, 0.0))
        if spared:
            hits = {at: w for at, w in hits.items() if not any(a <= at < b for a, b in spared)}
        n = max(1, len(folded.split()))
        return float(np.log1p(100 * sum(hits.values()) / n)), float(np.log1p(len(hits)))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + features @ np.array(self.curve[1:]), -30, 30)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def give() -> pa.RecordBatch:
        names = list(found[0].keys() | found[1].keys())
        return pa.record_batch([pa.array(names, pa.string()), *(pa.array([found[k][t] for t in names], pa.int64()) for k in (1, 0))], names=["term", "n1", "n0"])

    found: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            for label, text in zip(batch.column("label").slice(at, 100).to_pylist(), batch.column("text").slice(at, 100).to_pylist()):
                found[label].update(terms(text))
            if len(found[0]) + len(found[1]) > HELD_TERMS:
                yield give()
                found = {0: Counter(), 1: Counter()}
    yield give()


def _featured(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, column: str) -> Iterator[pa.RecordBatch]:
    automaton = lexicon.automaton()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            found = np.array([lexicon.features(t, automaton) for t in part.column("text").to_pylist()]).reshape(-1, 2)
            values = [pa.array(lexicon.score(found))] if column == "doc_id" else [pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.record_batch([part.column(column), *values], names=[column, *(["score"] if column == "doc_id" else ["density", "hits"])])


def _curve(rows: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, slightly ridged; weights of the features are not negative."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if not len(labels) or labels.min() == labels.max():
        return float(np.log(share / (1 - share))), 0.0, 0.0
    x, w = np.column_stack([np.ones(len(rows)), rows]), np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.array([1e-3, 0.05, 0.05])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (labels - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
    return float(w[0]), float(max(w[1], 0)), float(max(w[2], 0))


def learn(docs: DataFrame, labels: DataFrame, column: str = "toxic", most_rows: int = MOST_ROWS) -> Lexicon:
    """Lexicon and score curve from labelled rows that are not held out."""
    sample = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(labelled(labels, column, most_rows)), "doc_id").select("label", "text")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    lexicon = Lexicon({})
    if n1 and n0:
        counted = stored(sample.mapInArrow(lambda b: tidy(_count(b)), "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(F.col("n1") + F.col("n0") >= LEAST_DOCS), "terms")
        n, share = F.col("n1") + F.col("n0"), n1 / (n1 + n0)
        weight = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
        # Log likelihood ratio against the common share; at the log of the number of terms, chance alone would yield about one.
        surprise = F.col("n1") * F.log(F.col("n1") / (n * share)) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (n * (1 - share)))).otherwise(0.0)
        telling = counted.where(F.col("n1") >= LEAST_DOCS).withColumn("weight", weight).where((F.col("weight") >= LEAST_WEIGHT) & (surprise >= SURPRISE * math.log(max(2, counted.count()))))
        best = telling.orderBy(F.desc("weight"), F.desc("n1"), "term").limit(MOST_TERMS)
        lexicon.weights = {r["term"]: r["weight"] for r in best.select("term", "weight").collect()}
    fitted = sample.mapInArrow(lambda b: _featured(b, lexicon, "label"), "label int, density double, hits double").collect()
    lexicon.curve = _curve(np.array([r[1:] for r in fitted], float).reshape(-1, 2), np.array([r[0] for r in fitted], float))
    return lexicon


def toxicity_scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row: ``doc_id, held_out, score``."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = narrow.mapInArrow(lambda b: _featured(b, lexicon, "doc_id"), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def _spare(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, most: float) -> Iterator[pa.RecordBatch]:
    automaton = lexicon.automaton()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            found = np.array([lexicon.features(t, automaton) for t in part.column("text").to_pylist()]).reshape(-1, 2)
            yield part.filter(pa.array(lexicon.score(found) < most))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is below ``threshold``; ``text`` must be a string column."""
    return docs.mapInArrow(lambda b: tidy(_spare(b, lexicon, threshold)), docs.schema)
