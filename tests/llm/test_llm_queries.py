"""The registered queries: SQL twins, and the pipeline stage by stage."""

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from harvestry.llm.queries import ORACLES, QUERIES
from tools.check_queries import TABLES, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_all_are_offered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal([d[0] for d in result.description], result.fetchall())


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, rows = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        old = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids = sorted(r[0] for r in docs.select("doc_id").collect())
        if name == "toxicity":
            scored = {r["doc_id"] for r in QUERIES["op3_toxicity_lexicon"](spark, FOLDER).where("predicted = 0").collect()}
            assert set(ids) == scored
        elif name == "near_duplicates":
            assert ids == sorted({c for _, _, c in brute.near_duplicates(old)})
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            assert ids == sorted(w[0] for w in brute.decontaminated(old, items) if not w[5])
        elif name == "personal_data":
            assert ids == sorted(i for i, _ in old) and not docs.where(r"text rlike '[a-z0-9]@[a-z0-9]+\\.[a-z]'").count()
            assert not docs.where("n_chars <> length(text)").count()
        rows = ids
        assert name == "packing" or docs.columns == before
    assert set(rows) == {i for i, _ in old}
