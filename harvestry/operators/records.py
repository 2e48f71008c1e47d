"""Record builders: notice context, the four boards, enrichment and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions import markup as mk
from harvestry.functions.text import (classify_board, collapse, encode_body, extract_contact, extract_party, extract_phone, extract_project_no, first_non_empty,
                                      labeled_value, norm_text, pick, strip_tags, trade_type_gate, union_flag, unit_before_year)
from harvestry.session import scratch_path
from harvestry.sources.writers import write_routed
from harvestry.specs import words


@dataclass(frozen=True)
class Site:
    """Constants of one site."""

    province_code: str
    province_name: str
    city_id: str
    city_name: str
    web_source: str


BOARD_RULES = ((("候选人", "预中标", "入围投标人"), words.CANDIDATE), (("中标", "成交", "合同", "履约", "结果"), words.WIN))
MODULE_RULE = (words.INTENTION_MODULES, ("需求", "意向"), words.INTENTION)
RESULT_HEADERS = ("中标供应商名称", "供应商名称", "中标单位", "中标人", "成交供应商")


def common_context(pages: DataFrame, selectors: Sequence[str], labels: bool = False) -> DataFrame:
    """One pass over the pages: main block, text, tables and field map, then every field from its candidate list.

    ``pages`` carries url, html and the list row (title, publish_time, project_no, module, notice_type, trade_type).
    Fields come from the labelled map first, then text patterns, then the list row. ``labels`` adds the map's labels.
    """
    cut = pages.withColumn("main_html", mk.first_block("html", selectors))
    parsed = mk.parse_tables(cut, "main_html").withColumns({"lines": mk.plain_lines("main_html"), "detail_title": mk.extract_title("main_html"),
                              "_files": mk.file_anchors("html")})
    cleaned = parsed.withColumns({"files": mk.attachments("_files", F.col("url")), "_rows": F.transform("tables", lambda t: mk.clean_rows(t))}).drop("_files")
    rows = cleaned.withColumns({"fields": mk.field_map(mk.field_sources("main_html", F.col("_rows"), "lines")),
                                "result_rows": F.flatten(F.transform("_rows", lambda r: mk.header_zip(r, RESULT_HEADERS)))}).drop("_rows")
    field = lambda *names: [F.col("fields")[n] for n in names]
    result = lambda name: F.try_element_at("result_rows", F.lit(1))[name]
    return rows.withColumns({
        "title": first_non_empty("detail_title", "title"),
        "project_no": first_non_empty(*field("项目编号"), extract_project_no("lines"), "project_no"),
        "unit": first_non_empty(*field("采购人", "采购单位", "招标人", "招标单位", "建设单位"), extract_party("lines")),
        "company": first_non_empty(result("relation_company_name"), *field("中标单位", "中标人", "成交供应商")),
        "money": first_non_empty(result("render_money"), *field("中标金额", "中标金额(元)", "成交金额")),
        "contact_name": first_non_empty(*field("联系人"), extract_contact("lines")),
        "contact_phone": first_non_empty(*field("联系电话", "联系方式"), extract_phone("lines")),
        "board": classify_board(collapse("notice_type"), BOARD_RULES, words.BID, module=collapse("module"), module_rule=MODULE_RULE),
        **({"labels": F.map_keys("fields")} if labels else {}),
    }).drop("fields", "detail_title")


def _shared(site: Site) -> dict[str, Column]:
    has_body = F.when(F.col("main_html") != "", 1).otherwise(0)
    return {"provinceCode": F.lit(site.province_code), "originalWebsiteAddress": F.col("url"), "parentType": F.col("module"), "contentType": has_body, "htmlContent": encode_body("main_html")}


def _record(df: DataFrame, keep: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    return df.select(*keep, *[c.alias(name) for name, c in columns.items()])


def build_bid(context: DataFrame, site: Site, keep: Sequence[str] = ()) -> DataFrame:
    """Bid record; the title follows the project name."""
    from harvestry.functions.jsonx import contact_struct
    from harvestry.functions.money import budget_from_text
    from harvestry.functions.text import normalize_method

    gate = trade_type_gate(F.col("module"), F.col("trade_type"), words.TRADE_TYPE_MODULES, words.TRADE_TYPES)
    return _record(context, keep, {
        **_shared(site), "bidType": gate, "announcementTitle": F.col("title"), "procurementMethod": normalize_method(pick("lines", r"采购方式\s*[：:]\s*([^\n]+)")),
        "announcementType": F.col("notice_type"), "projectNum": F.col("project_no"), "projectName": F.col("title"), "budgetAmount": budget_from_text("lines"), "releaseSource": F.col("unit"),
        "releaseTime": F.col("publish_time"), "consultationInfo": contact_struct(F.col("unit"), F.col("contact_name"), F.col("contact_phone")), "fileInfo": F.col("files"), "webSource": F.lit(site.web_source)})


def build_win(context: DataFrame, site: Site, keep: Sequence[str] = (), rows: str = "first") -> DataFrame:
    """Win record with the union flag read from the winner's name.

    ``rows='all'`` gives one record per row of the result tables, with the shared fields copied; a page without rows keeps its one record, and only a
    single row takes what it lacks from the page's fields. ``'first'`` reads the first row alone.
    """
    from harvestry.functions.money import normalize_money
    from harvestry.functions.text import announcement_code

    if rows == "all":
        own = lambda field, shared: F.when(F.size("result_rows") > 1, F.coalesce(F.col(f"_row.{field}"), F.lit(""))).otherwise(F.col(shared))
        opened = context.select("*", F.explode_outer("result_rows").alias("_row"))
        context = opened.withColumns({"company": own("relation_company_name", "company"), "money": own("render_money", "money")})
    gate = trade_type_gate(F.col("module"), F.col("trade_type"), words.TRADE_TYPE_MODULES, words.TRADE_TYPES)
    return _record(context, keep, {
        **_shared(site), "tenderTitle": F.col("title"), "tenderNumber": F.col("project_no"), "cityId": F.lit(site.city_id), "cityName": F.lit(site.city_name), "renderMoney": normalize_money("money"),
        "renderDate": F.col("publish_time"), "renderType": F.when(F.col("module").isin(*words.TRADE_TYPE_MODULES), gate).otherwise(""), "procurementUnit": F.col("unit"), "relationCompanyName": F.col("company"),
        "uploadFileUrl": F.transform("files", lambda f: f["fileUrl"]), "announcementType": announcement_code("notice_type", words.CONTRACT_WORDS, 1), "projectClassification": F.lit(words.DEFAULT_PROJECT_CLASS),
        "isUnion": union_flag("company", "comma"), "contactName": F.col("contact_name"), "contactTelephone": F.col("contact_phone")})


def build_candidate(context: DataFrame, site: Site, keep: Sequence[str] = ()) -> DataFrame:
    """Candidate record; ranked names and the project number sit in the nested extra."""
    from harvestry.operators.ledger import rank_labels

    names = F.filter(F.transform("result_rows", lambda r: r["relation_company_name"]), lambda n: F.coalesce(n, F.lit("")) != "")
    return _record(context, keep, {
        **_shared(site), "tenderTitle": F.col("title"), "renderDate": F.col("publish_time"), "renderType": F.lit("中标候选人"), "procurementUnit": F.col("unit"), "relationCompanyName": F.col("company"),
        "uploadFileUrl": F.col("files"), "provinceName": F.lit(site.province_name), "cityId": F.lit(site.city_id), "cityName": F.lit(site.city_name), "announcementType": F.lit(words.CANDIDATE),
        "extra": F.struct(rank_labels(names).alias("candidateSort"), F.col("project_no").alias("tenderNumber")), "webSource": F.lit(site.web_source)})


def build_intention(context: DataFrame, site: Site, keep: Sequence[str] = ()) -> DataFrame:
    """Intention record with the page split into text, table and text."""
    shared = _shared(site)
    return _record(context, keep, {
        **{k: shared[k] for k in ("provinceCode", "originalWebsiteAddress", "parentType")}, "cityId": F.lit(site.city_id), "cityName": F.lit(site.city_name), "procurementTitle": F.col("title"),
        "releaseSource": unit_before_year("title"), "releaseDatetime": F.col("publish_time"), "releaseContentMix": mk.content_mix(F.col("tables"), mk.parse_parts("main_html"), F.col("title")), "fileInfo": F.col("files"),
        "bidType": F.col("notice_type"), "webSource": F.lit(site.web_source)})


BUILDERS = {words.BID: build_bid, words.WIN: build_win, words.CANDIDATE: build_candidate, words.INTENTION: build_intention}


def build_standard(context: DataFrame, site: Site, keep: Sequence[str] = (), **options: Mapping[str, str]) -> dict[str, DataFrame]:
    """Four outputs by board; ``options`` go to the board's builder. Route the context first when more than one output is written."""
    return {board: build(context.filter(F.col("board") == board), site, keep, **options.get(board, {})) for board, build in BUILDERS.items()}


def routed(context: DataFrame) -> DataFrame:
    """The context written once, a folder per board, and read back: each output then reads its own board's rows, and pages are parsed once."""
    path = scratch_path(context.sparkSession, "boards")
    write_routed(context, path, "board")
    return context.sparkSession.read.schema(context.schema).parquet(path)


def apply_enrichment(records: DataFrame, enriched: DataFrame, key: str, fields: Sequence[str], ok: str, reset: Sequence[str] = ()) -> DataFrame:
    """Pre-computed extraction results over rule output: listed fields are reset first on good rows; blank or failed results keep the rule value."""
    results = enriched.select(key, F.col(ok).alias("_ok"), *[norm_text(F.col(f), entities=False).alias(f"_e_{f}") for f in fields])
    joined = records.join(results, key, "left")
    good = F.coalesce(F.col("_ok"), F.lit(False))
    changes = {}
    for f in fields:
        base = F.when(good, F.lit("")).otherwise(F.col(f)) if f in reset else F.col(f)
        changes[f] = F.when(good & (F.col(f"_e_{f}") != ""), F.col(f"_e_{f}")).otherwise(base)
    return joined.withColumns(changes).select(*records.columns)


def profile_from_page(pages: DataFrame, key: str, id_pattern: str, labels: Mapping[str, str], intro_pattern: str, url: str = "url", html: str = "html") -> DataFrame:
    """Profile per page: id from the URL, name from the title cascade, labelled fields and the intro."""
    fields = [labeled_value(html, label).alias(name) for name, label in labels.items()]
    return pages.select(key, pick(url, id_pattern).alias("profile_id"), mk.extract_title(html).alias("name"), *fields, strip_tags(pick(html, intro_pattern)).alias("intro"))
