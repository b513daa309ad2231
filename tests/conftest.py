import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from starrung import Study, Workspace  # noqa: E402
from starrung.operators import joins  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starrung-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")  # results must not depend on it
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    with Workspace(spark) as workspace:
        yield workspace


@pytest.fixture(scope="session")
def dense(spark):
    return Study.of_tables(spark, DATA)


@pytest.fixture(scope="session")
def sparse(spark):
    return Study.of_tables(spark, DATA, sparse=True)


@pytest.fixture
def no_broadcast(monkeypatch):
    """Every lookup shuffles and every key may be heavy."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "HEAVY_ROWS", 1)
    monkeypatch.setattr(joins, "heavy_limit", lambda df: 5)


def rows(df):
    """Rows in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
