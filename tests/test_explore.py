import pytest
from conftest import rows

from starrung.operators.explore import (
    count_per_key,
    displayed,
    distinct_counts,
    frequencies,
    label_vocabulary,
    members,
    preview,
    sparse_matrix,
    sparse_sample,
    value_range,
)


@pytest.fixture
def df(spark):
    data = [(1, 10, 4.0, "a|b"), (1, 11, 3.0, "b"), (2, 10, 5.0, None), (2, 10, 2.0, "a"), (None, 12, 1.0, "c|a")]
    return spark.createDataFrame(data, "user_id int, item_id int, rating double, genres string")


def test_counts(df):
    assert rows(count_per_key(df, "user_id")) == [(None, 1), (1, 2), (2, 2)]
    assert rows(distinct_counts(df, users="user_id", items="item_id")) == [(3, 3)]
    assert rows(distinct_counts(df.limit(0), users="user_id")) == [(0,)]


def test_frequencies_drop_null_and_sort(df):
    assert [tuple(r) for r in frequencies(df, "user_id").collect()] == [(1, 2), (2, 2)]
    assert [tuple(r) for r in frequencies(df, "item_id", weight="rating").collect()] == [
        (10, 11.0), (11, 3.0), (12, 1.0)
    ]


def test_range(df):
    assert rows(value_range(df, "item_id")) == [(10, 12)]
    assert rows(value_range(df, "user_id")) == [(None, None)]
    assert rows(value_range(df, "user_id", "skip")) == [(1, 2)]


def test_vocabulary(df):
    assert rows(label_vocabulary(df, "genres")) == [("a",), ("b",), ("c",)]


def test_preview(df):
    assert [r.rating for r in preview(df, ["rating"], 2).collect()] == [1.0, 2.0]


def test_members_of_two_columns(ws, spark, df):
    users = spark.createDataFrame([(1,), (2,)], "u int")
    items = spark.createDataFrame([(10,), (12,)], "i int")
    assert rows(members(ws, df, user_id=users, item_id=items).select("user_id", "item_id")) == [
        (1, 10), (2, 10), (2, 10)
    ]


def test_sparse_matrix(df):
    got = sparse_matrix(df, "user_id", "item_id", "rating", [10, 11, 12])
    assert got.columns == ["user_id", "10", "11", "12"]
    assert rows(got) == [(None, None, None, 1.0), (1, 4.0, 3.0, None), (2, 5.0, None, None)]


def test_sparse_sample(ws, df):
    got = sparse_sample(ws, df, "user_id", "item_id", "rating", rows=3, columns=2, seed=1)
    assert got.columns == ["user_id", "pick_1", "pick_2"]
    assert got.count() == 3


@pytest.mark.parametrize("values, shown", [
    ([1.0612345, 0.94321449, None], ["1.061235", "0.943214", None]),
    ([1.5, 0.25, 100.0], ["1.50", "0.25", "100.00"]),
    ([9.9999996, 3.0], ["10", "3"]),
    ([123456789.0, 0.0, -2.5], ["123456789.0", "0.0", "-2.5"]),
    ([None, float("nan")], [None, "NaN"]),
])
def test_displayed_by_significant_digits(spark, ws, values, shown):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = displayed(ws, df)
    assert got.dtypes == [("i", "int"), ("x", "string")]
    assert [r.x for r in got.orderBy("i").collect()] == shown
    assert displayed(ws, df.limit(0)).collect() == [] and displayed(ws, df.select("i")).count() == len(values)
