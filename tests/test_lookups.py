"""Lookups of a key that holds a third of the rows, entity resolution over shared suffixes, validation of repeated keys, and the notices job."""

import pytest
from pyspark.sql import functions as F

from harvestry.functions.jsonx import parse_payload
from harvestry.operators import flagships, joining, quality, records, rollups, sets
from harvestry.specs import words

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
}


@pytest.fixture
def skewed(spark):
    """Broadcasts off and small partitions count as skewed."""
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_a_task(df):
    return max(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())


@pytest.fixture
def hot(skewed):
    """9,000 rows, a third of them of one key, in many files."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 900))
    return skewed.range(9000, numPartitions=24).select(key.alias("key"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))


@pytest.mark.parametrize("look", [
    lambda rows, keys: joining.resolve_exact(rows, "key", keys.select(F.col("key").alias("name"), F.col("key").alias("code")), "name", ["code"]),
    lambda rows, keys: joining.done_gate(rows, "key", keys)[1],
    lambda rows, keys: sets.except_done(rows, keys, ["key"]),
], ids=["resolve_exact", "done_gate", "except_done"])
def test_a_hot_key_is_split(hot, look):
    keys = hot.sparkSession.range(400).select(F.concat(F.lit("k"), "id").alias("key"))
    found = look(hot, keys)
    known = hot.join(keys, "key", "left_semi").count()
    assert found.count() in (9000, 9000 - known)
    assert rows_a_task(found) < 3000  # the hot key alone has 3,000


def test_new_members_meet_reduced_sets(hot):
    assert sorted(r[0] for r in rollups.new_members(hot.filter("id < 12"), hot.filter("id % 3 = 0 or id in (1, 2)"), "key").collect()) == ["k10", "k11", "k4", "k5", "k7", "k8"]


def test_a_suffix_that_all_records_share(spark):
    ref = spark.range(2000).select(F.col("id").alias("code"), F.concat(F.lit("市第"), "id", F.lit("医院")).alias("name"), F.lit("x" * 50).alias("address"))
    ref = ref.unionByName(ref.filter("code = 7").withColumn("code", F.lit(9007)))
    asked = spark.createDataFrame([("医院",), ("第12医院",), ("第7医院",), ("市第7医院",), ("不在",), (" ",), (None,)], "q string")
    got = {r.q: (r.code, r.match_kind, r.resolved, r.address and len(r.address)) for r in joining.resolve_entity(asked, "q", ref, "name", ["code"]).collect()}
    lost = (None, "", "N", None)
    assert got == {"医院": lost, "第12医院": (12, "suffix", "Y", 50), "第7医院": lost, "市第7医院": (7, "exact", "Y", 50), "不在": lost, " ": lost, None: lost}
    assert joining.resolve_entity(asked.limit(0), "q", ref, "name", ["code"]).count() == 0 and joining.resolve_entity(asked, "q", ref.limit(0), "name", ["code"]).filter("resolved = 'Y'").count() == 0


def test_records_never_pass_the_suffix_join(spark):
    ref = spark.createDataFrame([(1, "甲市第一医院", "wide")], "code int, name string, payload string")
    plan = joining.resolve_entity(spark.createDataFrame([("第一医院",)], "q string"), "q", ref, "name", ["code"])._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("\n"):
        assert "Generate" not in line or "payload" not in line


def test_repeated_keys_over_many_tasks(spark, spread):
    rows = spark.range(600, numPartitions=7).select("id", parse_payload(F.concat(F.lit('{"k":'), F.when(F.col("id") % 3 == 0, F.lit("1")).when(F.col("id") == 4, F.lit("null")).otherwise(F.col("id").cast("string")), F.lit("}"))).alias("r"))
    checks = quality.Checks(unique_by=["k"])
    got = {(r.id, r.issue) for r in quality.validate(rows, "r", "id", checks).collect()}
    assert got == {(k, "duplicate_key") for k in (1, *range(3, 600, 3))} | {(4, "key_incomplete")}  # row 1 has the key 1, too
    report = quality.validation_report(rows, "r", "id", checks).first()
    assert (report.records, report.issues, report.more) == (600, len(got), len(got) - 50)


SITE = records.Site("9", "省", "90", "市", "平台")


@pytest.fixture
def landed(spark):
    page = lambda body: f"<html><body>{body}</body></html>"
    winners = "<table><tr><th>中标单位</th><th>中标金额（元）</th></tr><tr><td>甲公司</td><td>5</td></tr><tr><td>乙公司</td><td>6</td></tr></table>"
    cards = spark.createDataFrame([
        (1, "u1", "列表", "国企采购", "中标公告"), (2, "u2", "列表", "土地矿产", "招标公告"), (3, "u3", "列表", "土地矿产", "招标公告"), (4, "u4", "列表", "政府采购", "采购需求(意向)"),
        (5, "u5", "列表", "国企采购", "中标候选人公示"), (6, "gone", "列表", "国企采购", "招标公告"), (7, "empty", "列表", "国企采购", "招标公告"), (8, "u1", "同页", "国企采购", "合同及履约"),
    ], "card int, url string, title string, module string, notice_type string").withColumns({"publish_time": F.lit("2020-01-01"), "project_no": F.lit("L"), "trade_type": F.lit("施工")})
    pages = spark.createDataFrame([
        ("u1", page(f'<div class="wrap"><h1>甲乙</h1>{winners}</div>')), ("u1", "<p>cut"), ("u2", page('<div class="wrap"><h1>空</h1><p>发布日期：2020-01-01</p></div>')),
        ("u3", page('<div class="wrap"><h1>实</h1><p>项目编号：AB-1</p><p>采购单位：丙局</p></div>')), ("u4", page("<p>没有主块")), ("u5", page(f'<div class="wrap">{winners}')), ("empty", ""), ("empty", None), (None, "x")], "url string, html string")
    return cards, pages


def test_notices(spark, landed):
    cards, pages = landed
    results = spark.createDataFrame([(1, True, " 模型 ", ""), (8, False, "no", "no")], "card int, ok boolean, tenderTitle string, procurementUnit string")
    extra = {words.WIN: flagships.Enrichment(results, ["tenderTitle", "procurementUnit"], "ok", ["procurementUnit"])}
    boards = flagships.notices(cards, pages, [".wrap", "body"], SITE, "card", extra)
    ids = {b: sorted(r.card for r in df.collect()) for b, df in boards.items()}
    assert ids == {words.WIN: [1, 8], words.BID: [3], words.INTENTION: [4], words.CANDIDATE: [5]}  # 2 is blank, 6 has not landed, 7 is empty
    wins = {r.card: (r.tenderTitle, r.relationCompanyName, r.renderMoney, r.announcementType) for r in boards[words.WIN].collect()}
    assert wins == {1: ("模型", "甲公司", "5元", 2), 8: ("甲乙", "甲公司", "5元", 1)}
    bid = boards[words.BID].first()
    assert (bid.announcementTitle, bid.projectNum, bid.releaseSource) == ("实", "AB-1", "丙局")
    assert boards[words.CANDIDATE].first().extra.candidateSort == ["第一候选人：甲公司", "第二候选人：乙公司"] and boards[words.INTENTION].first().procurementTitle == "列表"


def test_notices_with_all_winners_and_of_nothing(landed):
    cards, pages = landed
    boards = flagships.notices(cards, pages, [".wrap", "body"], SITE, "card", win_rows="all")
    assert sorted((r.card, r.relationCompanyName) for r in boards[words.WIN].collect()) == [(1, "乙公司"), (1, "甲公司"), (8, "乙公司"), (8, "甲公司")]
    assert all(df.count() == 0 for df in flagships.notices(cards.limit(0), pages, [".wrap"], SITE, "card").values())
    assert all(df.count() == 0 for df in flagships.notices(cards, pages.limit(0), [".wrap"], SITE, "card").values())


def test_boards_read_their_own_folder(landed):
    cards, pages = landed
    plan = flagships.notices(cards, pages, [".wrap"], SITE, "card")[words.BID]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(board" in plan and "ArrowEvalPython" not in plan.split("FileScan")[-1]
