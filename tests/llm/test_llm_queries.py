"""The numbered queries against SQL, and the pipeline against plain versions of its stages."""

import re

import compare
import corpus_pipeline
import pytest
from conftest import DATA
from llm_rows import documents, read
from test_decontam import plain as plain_benchmark
from test_exact import plain as plain_exact
from test_jaccard import plain as plain_jaccard

import __spark_entry__ as entry
from starrung.llm.queries import QUERIES, SQL
from starrung.llm.tables import scratch


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_like_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, DATA), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_a_row_for_each_document(spark, name):
    got = QUERIES[name](spark, DATA)
    ids = sorted(r.doc_id for r in got.collect())
    assert ids == sorted(r.doc_id for r in read(spark, "documents").collect())


def test_all_operators_are_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_a_repeated_call_replaces_the_tables_of_the_last(spark):
    first = scratch(spark, "twice")
    first.table(spark.range(3), "t").count()
    second = scratch(spark, "twice")
    second.table(spark.range(3), "t").count()
    assert second.intact() and not first.intact()


def test_pipeline_like_plain_stages(spark, tmp_path):
    docs = read(spark, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "mixing"]
    bench = [(r.item_id, r.text) for r in read(spark, "benchmark").collect()]
    plain = {
        "exact_dedup": lambda rows: {r[0] for r in plain_exact(rows) if r[3]},
        "jaccard_join": lambda rows: {r[0] for r in plain_jaccard(rows) if r[0] == r[2]},
        "decontamination": lambda rows: {r[0] for r in plain_benchmark(rows, bench) if not r[2]},
    }
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        columns = docs.columns
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= dict(before).items() and len(after) == docs.count() > 0
        if name in plain:
            assert set(after) == plain[name](before)
        if name != "mixing":
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, DATA).select("doc_id", "taken").collect() != []


def test_stages_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "other"), (None, "null id"), (None, "null id"), (None, "more"),
            (4, "a  b"), (5, "x" * 100_000), (6, " ".join(f"w{i}" for i in range(50))), (7, " ".join(f"w{i}" for i in range(51)))]
    docs = documents(spark, rows)
    left = {name: sorted((r.doc_id or 0, r.text) for r in stage(spark, docs, DATA).fillna("", "text").collect())
            for name, stage in corpus_pipeline.STAGES}
    assert len(left["toxicity"]) == len(left["decontamination"]) == len(rows)
    assert len(left["exact_dedup"]) == 8  # null as empty, "a b" four times, "null id" twice
    assert len([r for r in left["jaccard_join"] if r[0] in (6, 7)]) == 1
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).collect() == []
