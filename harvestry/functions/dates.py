"""Dates kept as text, with a parsed form where one is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.functions.text import collapse, let, pick, strip

FULL_DATE = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
FULL_TIME = r"^(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"


def parsed_date(c: Column | str) -> Column:
    """Date of ``y-m-d`` text with or without a time; null for anything else."""
    def parse(text: Column) -> Column:
        day = F.try_to_date(F.substring_index(F.regexp_replace(text, r"\s+", " "), " ", 1), "yyyy-M-d")
        part = lambda group: F.regexp_extract(text, FULL_TIME, group).try_cast("int")
        timed = text.rlike(FULL_TIME) & (part(4) < 24) & (part(5) < 60) & (part(6) < 62)
        return F.when(text.rlike(FULL_DATE) | timed, day)

    return let(strip(c), parse)


def iso_date(c: Column | str) -> Column:
    """ISO text when the value parses, otherwise the stripped text."""
    return F.coalesce(F.date_format(parsed_date(c), "yyyy-MM-dd"), strip(c), F.lit(""))


def month_text(c: Column | str) -> Column:
    """``yyyy-MM`` when there is one, else a year, else the text."""
    picks = lambda text: F.coalesce(*[F.nullif(pick(text, p), F.lit("")) for p in (r"(\d{4}-\d{2})", r"(\d{4})")], text)
    return let(F.coalesce(strip(c), F.lit("")), picks)


def trim_seconds(c: Column | str) -> Column:
    return F.regexp_replace(collapse(c), ":00$", "")


def find_date(c: Column | str) -> Column:
    return pick(c, r"(\d{4}[/-]\d{2}[/-]\d{2}(?:\s+\d{2}:\d{2}(?::\d{2})?)?)")
