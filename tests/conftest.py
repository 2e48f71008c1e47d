import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from harvestry import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def spread(spark):
    """Many real partitions, so work that crosses partition borders is tested on small data."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def one(spark):
    """Evaluate a column on literals: ``one(column, a='x')``."""
    from pyspark.sql import functions as F

    def run(column, **values):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
        return df.select(column.alias("out")).first()["out"]
    return run
