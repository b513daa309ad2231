"""Every named query against its SQL on the same files."""

import os

import compare
import pytest
from conftest import DATA

import __spark_entry__ as entry
import oracle_queries
from starrung.plans import queries

QUERIES, SQL = queries.all_queries(), oracle_queries.all_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(QUERIES[name](spark, DATA), con, SQL[name]) is None


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["model", "title", "rmse"]
    assert got.count() == 8


def test_queries_share_a_study_until_its_files_change(spark, tmp_path):
    for name in ("lineitem", "orders", "part"):
        (tmp_path / f"{name}.parquet").write_bytes(open(f"{DATA}/{name}.parquet", "rb").read())
    first = queries._study(spark, str(tmp_path))
    assert queries._study(spark, str(tmp_path)) is first
    assert queries._study(spark, str(tmp_path), sparse=True) is not first
    first.ratings.count()
    assert queries._study(spark, str(tmp_path)) is first
    os.utime(tmp_path / "part.parquet", (1, 1))
    second = queries._study(spark, str(tmp_path))
    assert second is not first
    second.ratings.count()
    second.ws.release()
    assert queries._study(spark, str(tmp_path)) is not second


def test_repeated_queries_write_no_further_tables(spark):
    for name in ("apply_effect", "read_ratings"):
        QUERIES[name](spark, DATA).count()
        root = queries._study(spark, DATA).ws.root.removeprefix("file:")
        before = sorted(os.listdir(root))
        QUERIES[name](spark, DATA).count()
        assert sorted(os.listdir(root)) == before


def test_forgetting_studies_deletes_their_tables(spark, monkeypatch):
    monkeypatch.setattr(queries, "_studies", {})
    study = queries._study(spark, DATA)
    assert study.ratings.count() > 0 and study.ws.intact()
    queries.forget_studies()
    assert not study.ws.intact() and not queries._studies
