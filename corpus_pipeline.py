"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import decontam, jaccard, packing, pii, toxicity
from harvestry.llm.common import stored, table
from harvestry.llm.queries import SEQUENCE_TOKENS, TOXIC, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the lexicon is learned from ``labels`` and these documents."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")), TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8."""
    return jaccard.drop_near_duplicates(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word passage of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the remaining documents in training sequences."""
    return packing.pack(docs, tokenizer_file(), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("personal_data", redact_personal_data), ("packing", pack),
]
#: SQL cannot express the stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
