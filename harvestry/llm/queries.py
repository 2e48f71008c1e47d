"""One query per operator, over its whole table with production parameters, and the SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import alignment, chat, decontam, hostrep, jaccard, linerules, mainhtml, merkle, packing, pii, quality, simhash, toxicity, twins
from harvestry.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SEQUENCE_TOKENS = 2048
#: Scores from which a document counts as toxic, and as good.
TOXIC, GOOD = 0.3, 0.7


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file(), SEQUENCE_TOKENS)


@query("op2_chat_formatting")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


@query("op2_whole_conversations")
def op2_whole(spark: SparkSession, folder: str) -> DataFrame:
    return chat.conversations(table(spark, folder, "conversations"))


@query("op3_toxicity_lexicon")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.toxicity_scores(docs, toxicity.learn(docs, table(spark, folder, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


@query("op4_host_reputation", twins.HOST_REPUTATION)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return hostrep.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query("op5_html_extraction")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mainhtml.extract(table(spark, folder, "pages"))


@query("op6_benchmark_decontamination", twins.DECONTAMINATION)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("places") > 0).alias("contaminated"))


@query("op7_personal_data")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans_of(table(spark, folder, "documents"))
    counts = (F.size(pii.of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in pii.KINDS)
    return found.select("doc_id", *counts, F.sha2(pii.shown(F.col("base")), 256).alias("base_sha256"), pii.shown(F.col("spans")).alias("spans"))


@query("op8_line_quality_rules", twins.LINE_RULES)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = linerules.judged(table(spark, folder, "documents"), least_words=50, most_repeated=50, least_kept=0.5)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_chars")


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


@query("op10_ngram_jaccard_join", twins.JACCARD)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), size=5, percent=80)


@query("op11_simhash_near_duplicates")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), size=3, radius=3)


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query("op13_merkle_manifest", twins.MANIFEST)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))
