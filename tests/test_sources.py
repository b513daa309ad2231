import re

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from starrung.sources import describe_schema, joined, malformed_ratings, read_items, read_ratings
from starrung.sources.star import ratings_of


def test_read_ratings(spark, tmp_path):
    (tmp_path / "r.dat").write_text("1::122::5::838985046\n1::185::0.5::838983525\n")
    df = read_ratings(spark, str(tmp_path))
    assert df.dtypes == [("user_id", "bigint"), ("item_id", "bigint"), ("rating", "double"), ("ts", "bigint")]
    assert rows(df) == [(1, 122, 5.0, 838985046), (1, 185, 0.5, 838983525)]


def test_read_items_keeps_quotes_short_rows_and_separators(spark, tmp_path):
    (tmp_path / "m.dat").write_text(
        '838::"Great Performances" Cats (1998)::Musical\n'
        "9::Only a title\n"
        "10::T::a::b\n"
        'x::"Open::Drama\n'
    )
    assert rows(read_items(spark, str(tmp_path))) == [
        (None, '"Open', "Drama"),
        (10, "T", "a::b"),
        (838, '"Great Performances" Cats (1998)', "Musical"),
        (9, "Only a title", ""),
    ]


def test_joined_keeps_ratings_of_unlisted_items(spark, ws):
    ratings = spark.createDataFrame([(1, 1, 3.0), (1, 2, 4.0)], "user_id int, item_id int, rating double")
    items = spark.createDataFrame([(1, "A", "x")], "item_id int, title string, genres string")
    assert rows(joined(ws, ratings, items).select("item_id", "title")) == [(1, "A"), (2, None)]


def test_describe_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert rows(describe_schema(df)) == [(1, "x", "int", 2), (2, "y", "string", 2)]


def test_malformed_ratings_are_told(spark, tmp_path):
    path = tmp_path / "ratings.dat"
    path.write_text("1::2::3.5::100\n1::x::3.5::100\n1::2::3\n1::2::3::4::5\n\n-1::2::0::0\n")
    assert rows(malformed_ratings(spark, str(path))) == [("",), ("1::2::3",), ("1::2::3::4::5",), ("1::x::3.5::100",)]


@pytest.fixture
def shuffled_joins(spark):
    """Joins are sorted, and what is skewed is told from tables of some kilobytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "32k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_an_order_with_a_third_of_all_lines_is_split(spark, tmp_path, shuffled_joins):
    """The join with the orders deals the lines of one order to several tasks, and loses none."""
    lines, orders = (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("lineitem", "orders"))
    one = orders.agg(F.min("o_orderkey")).first()[0]
    hot = F.when(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0, F.lit(one)).otherwise(F.col("l_orderkey"))
    lines = lines.withColumn("l_orderkey", hot.cast(lines.schema["l_orderkey"].dataType))
    lines.repartition(16).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = ratings_of(spark, str(tmp_path), sparse=True)
    counts = {r["user_id"]: r["count"] for r in got.groupBy("user_id").count().collect()}
    written = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    assert counts == {r["l_orderkey"]: r["count"] for r in written.groupBy("l_orderkey").count().collect()}
    assert counts[one] > written.count() / 4
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin\(skew=true\)", plan)
    assert "Python" not in plan
