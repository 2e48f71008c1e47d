"""Whole jobs composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.dates import iso_date
from harvestry.functions.text import strip_edge_noise
from harvestry.operators import records as rc
from harvestry.operators.joining import pending, resolve_entity
from harvestry.operators.ordering import keep_first
from harvestry.operators.rollups import clean_names
from harvestry.operators.shaping import is_blank_detail, is_viable_entity_name, project
from harvestry.session import pinned
from harvestry.sources.readers import union_sources
from harvestry.sources.writers import upsert


def daily_new(datasets: Mapping[str, tuple[DataFrame, str]], layout: Mapping[str, str], key: str, dates: Sequence[str], on: str, day: str, row_order: str) -> DataFrame:
    """Tag and stack datasets, bring them to one layout, keep one day, first row per key in dataset order."""
    stacked = union_sources(datasets)
    shaped = project(stacked, {**layout, "source_dataset": "dataset_name", "source_catalog_id": "catalog_id", "_dataset": "dataset_order", "_row": row_order}, required=[key])
    dated = shaped.withColumns({d: iso_date(d) for d in dates}).filter(F.col(on) == day)
    ordered = dated.withColumns({"_dataset": F.col("_dataset").cast("bigint"), "_row": F.col("_row").cast("bigint")})
    return keep_first(ordered, [key], ["_dataset", "_row"]).drop("_dataset", "_row")


def entity_backfill(names: DataFrame, name: str, known: DataFrame, reference: DataFrame, reference_name: str, reference_id: str, attributes: Sequence[str],
                    viable=is_viable_entity_name) -> DataFrame:
    """Distinct usable names that are not processed yet → resolved against the reference → upserted into the known entities.

    ``known`` has ``entity_key, query_name, entity_name, resolved`` and the attributes.
    """
    # Raw repeats go first: cleaning is the costly part, and distinct combines map-side.
    clean = clean_names(names.select(name).distinct(), name, viable).filter("viable").select(F.col("normalized").alias("query_name")).distinct()
    # Both are read several times below; pinned, each is computed once.
    todo = pinned(pending(clean, "query_name", known, ["query_name", "entity_name"]))
    found = resolve_entity(todo, "query_name", reference, reference_name, [reference_id])
    text = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))
    hit = F.col("resolved") == "Y"
    items = found.select(
        F.when(hit & (text(reference_id) != ""), text(reference_id)).otherwise(F.col("query_name")).alias("entity_key"), "query_name",
        F.when(hit, strip_edge_noise(F.col(reference_name))).otherwise(F.col("query_name")).alias("entity_name"), "resolved",
        *[F.when(hit, text(a)).otherwise("").alias(a) for a in attributes])
    return upsert(known, pinned(items), ["entity_key"], ["query_name"])


def backfill_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("resolved").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Enrichment:
    """Extraction results of one board, by card: ``fields`` that may override the record's, whether the result is ``ok``, and fields reset on good rows."""

    results: DataFrame
    fields: Sequence[str]
    ok: str
    reset: Sequence[str] = ()


def with_pages(cards: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """List cards with their detail page. A card whose page has not landed, or is empty, waits; of several captures of one address the longest counts,
    then the first by text."""
    whole = pages.filter(F.coalesce(F.length("html"), F.lit(0)) > 0)
    kept = whole.groupBy(url).agg(F.max_by("html", F.struct(F.length("html"), F.xxhash64("html"))).alias("html"))
    return cards.join(kept, url)


def notices(cards: DataFrame, pages: DataFrame, selectors: Sequence[str], site: rc.Site, key: str, enriched: Mapping[str, Enrichment] | None = None,
            win_rows: str = "first", blank_tasks: Sequence[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """List cards and landed pages to the records of the four boards.

    Cards meet their pages by address; each page is parsed once into its context, which is written once, a folder per board. From there each board's builder reads
    its own folder, without the notices whose detail is blank (for the tasks that the rule is bound to). Extraction results of a board, where there
    are any, are laid over its records by ``key``, a column of the cards.

    Cards carry url, title, publish_time, project_no, module, notice_type and trade_type. Nothing is collected and nothing is parsed twice.
    """
    context = rc.routed(rc.common_context(with_pages(cards, pages), selectors, labels=True).drop("html"))
    tasks = {} if blank_tasks is None else {"tasks": blank_tasks}
    blank: Column = is_blank_detail(F.col("module"), F.col("notice_type"), F.col("title"), F.col("labels"), F.size("result_rows"), F.col("lines"), **tasks)
    boards = rc.build_standard(context.filter(~blank), site, [key], **{rc.words.WIN: {"rows": win_rows}})
    for board, extra in (enriched or {}).items():
        boards[board] = rc.apply_enrichment(boards[board], extra.results, key, extra.fields, extra.ok, extra.reset)
    return boards
