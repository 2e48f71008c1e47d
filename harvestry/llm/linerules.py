"""Line-first quality rules: judge each line, drop those that fail, and reject documents that lose too much text. SQL functions only.

A line fails for its punctuation (symbols, or exclamation marks, make up much of it; it is all capitals; it has no letter or digit), as
navigation (cells between bars or arrows; a menu label without a full stop), as boilerplate (licence, cookie and legal phrases), or because
an earlier line of the text is the same. ``kept`` is false if a base rule fails or less than ``least_kept`` of the text's characters stand
in lines that pass. Everything happens within a row, so there is no shuffle.

Defined results: a null text is an empty one; it has no words and fails the base rule on length. Rows are judged one by one, so ids may be
null and rows may repeat. Three-word windows are compared by 64-bit hash. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The space characters of a word's definition, and the symbols that are counted, as classes.
BLANKS, BLANK_RUN, SYMBOLS = " \t\n\x0b\x0c\r", "[\\x20\\x09-\\x0D]+", "[#*$%&|<>]+"
BOILERPLATE = (
    r"all rights reserved|(?:un)?licen[sc]ed under|general public license|copyright|©|cookies? (?:policy|settings)|uses? cookies|"
    r"privacy policy|terms of (?:use|service)|subscribe to|sign up for|enable javascript|lorem ipsum|click here"
)
#: Menu labels have at most this many characters.
MENU_CHARS = 24
MENU = r"^\s*(?:home|menu|log ?in|sign in|search|contact|about(?: us)?|next|previous|share|tweet|print|read more|back to top|skip to \w+)\s*$"


def _without(c: Column, marks: str) -> Column:
    return F.length(F.regexp_replace(c, marks, ""))


def _measured(line: Column) -> Column:
    """A line with its characters outside blanks, and in lower case."""
    return F.struct(line.alias("text"), _without(line, BLANK_RUN).alias("n"), F.lower(line).alias("low"))


def line_passes(line: Column) -> Column:
    """Whether a measured line that has a word passes all rules."""
    text, n = line["text"], line["n"]
    symbols = F.length(text) - _without(text, r"[#*$%&|<>~^_=+{}\[\]\\@]+")
    shouts = F.length(text) - _without(text, "[!?]+")
    cells = F.length(text) - _without(text, "[|»›→•]+")
    capitals = (n > 12) & ~text.rlike(r"\p{Ll}") & text.rlike(r"\p{Lu}")
    punctuation = (symbols * 10 > n) | (shouts * 12 > n) & (shouts > 2) | capitals | ~text.rlike(r"[\p{L}\p{N}]")
    navigation = (cells >= 3) | (n <= MENU_CHARS) & line["low"].rlike(MENU)
    return ~(punctuation | navigation | line["low"].rlike(BOILERPLATE))


def _windows(words: Column) -> Column:
    last = F.greatest(F.size(words) - 3, F.lit(0))
    return F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])))


def _places_again(placed: Column) -> Column:
    """Places of windows that are there again; sorted by hash, each of them has a neighbour like it."""
    same = lambda k, j: F.get(placed, j)["h"] == placed[k]["h"]
    marked = F.transform(F.sequence(F.lit(0), F.size(placed) - 1), lambda k: F.when(same(k, k - 1) | same(k, k + 1), placed[k]["i"]))
    return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))


def _covered(places: Column) -> Column:
    """Words in windows of three from each of the sorted places on."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).cast("bigint").alias("n"), i.alias("last"))
    return F.coalesce(F.aggregate(places, start, step)["n"], F.lit(0)).cast("long")


def judged(docs: DataFrame, least_words: int = 50, most_repeated: int = 50, least_kept: float = 0.5) -> DataFrame:
    """Per row: the counts, ``base_failed``, the characters in lines that pass (``left_chars``), and ``kept``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Each step is a projection of its own, so that no array is made twice.
    trimmed = docs.select("doc_id", text.alias("text")).withColumn("trimmed", F.btrim("text", F.lit(BLANKS)))
    words = F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", BLANK_RUN))
    cut = trimmed.select("doc_id", (F.length("text") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"), words.alias("words"),
                         F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    lines = cut.select("doc_id", "n_symbols", F.size("words").cast("long").alias("n_words"), F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)).alias("word_chars"),
                       _windows(F.col("words")).alias("windows"), F.size("lines").alias("n_lines"), F.array_distinct("lines").alias("lines"))
    lines = lines.withColumn("n_dup_lines", (F.col("n_lines") - F.size("lines")).cast("long")).withColumn("lines", F.transform("lines", _measured))
    counted = lines.select(
        "doc_id", "word_chars", "n_symbols", "n_words", "n_dup_lines", F.aggregate(F.filter("lines", line_passes), F.lit(0).cast("bigint"), lambda n, x: n + x["n"]).alias("left_chars"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("placed"))
    again = counted.withColumn("places", _places_again(F.col("placed"))).drop("placed").withColumn("n_repeat_words", _covered(F.col("places"))).drop("places")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return again.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("left_chars") >= least_kept * F.col("word_chars")))
