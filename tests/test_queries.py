"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from harvestry.plans import registry
from tools.check_queries import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
registry.load_all()
QUERIES, TWINS = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(TWINS) == set(QUERIES)


def test_entry_offers_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(TWINS) <= set(entry.oracle_sql())


def test_names_carry_survey_ids():
    ids = {name.split("_")[0] for name in QUERIES}
    wanted = {"s": 7, "k": 6, "p": 20, "j": 13, "a": 12, "v": 8, "w": 6, "o": 4, "u": 4, "h": 33, "l": 10, "d": 4, "m": 9, "g": 15, "x": 21, "b": 10, "q": 7}
    assert {f"{k}{i}" for k, n in wanted.items() for i in range(1, n + 1)} <= ids


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(TWINS[name])
    assert mine == normal([d[0] for d in result.description], result.fetchall())
