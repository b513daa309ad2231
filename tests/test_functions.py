import pytest
from conftest import rows
from pyspark.sql import functions as F

from starrung import functions as fn
from starrung.functions.labels import flag_names
from starrung.functions.measures import max_of, mean_of, min_of


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "title, year",
    [("Plain (1994)", 1994), ("NoYear", None), ("Short (1999) (2003)", 1999), (None, None), ("Odd (199) (12345)", None)],
)
def test_release_year(spark, title, year):
    assert one(spark, title, "string", fn.release_year) == year


@pytest.mark.parametrize("title, sequel", [("A: B (2000)", True), ("A (2000)", False), (None, None)])
def test_sequel_flag(spark, title, sequel):
    assert one(spark, title, "string", fn.sequel_flag) is sequel


@pytest.mark.parametrize("genres, count", [("a|b|c", 3), ("(no genres listed)", 1), (None, None)])
def test_label_count(spark, genres, count):
    assert one(spark, genres, "string", fn.label_count) == count


@pytest.mark.parametrize(
    "genres, label, substring, token",
    [
        ("cold", "old", 1, 0),
        ("cold|old", "old", 1, 1),
        ("Cold", "cold", 0, 0),
        ("(no genres listed)", "(no genres listed)", 1, 1),
        (None, "old", None, None),
    ],
)
def test_label_flag(spark, genres, label, substring, token):
    assert one(spark, genres, "string", lambda x: fn.label_flag(x, label)) == substring
    assert one(spark, genres, "string", lambda x: fn.label_flag(x, label, "token")) == token


def test_label_as_pattern(spark):
    label = "(no genres listed)"
    assert one(spark, "no genres listed", "string", lambda x: fn.label_flag(x, label, "regex")) == 1
    assert one(spark, "no genres listed", "string", lambda x: fn.label_flag(x, label)) == 0
    assert one(spark, "Sci-Fi|War", "string", lambda x: fn.label_flag(x, "Sci-Fi", "regex")) == 1
    assert one(spark, None, "string", lambda x: fn.label_flag(x, label, "regex")) is None


def test_label_flag_mode_is_checked():
    with pytest.raises(ValueError):
        fn.label_flag(F, "a", "fuzzy")


def test_movie_labels_have_one_flag_each(spark):
    assert len(fn.MOVIE_LABELS) == 20
    df = spark.createDataFrame([("Sci-Fi|War",)], "genres string")
    row = df.select(*fn.label_flags(F.col("genres"), fn.MOVIE_LABELS)).first().asDict()
    assert len(row) == 20
    assert {k for k, v in row.items() if v == 1} == {"is_scifi", "is_war"}


def test_flag_names_stay_distinct():
    assert flag_names(["LARGE", "large", "Large"]) == ["is_large", "is_large_2", "is_large_3"]


def test_profile_is_null_for_null(spark):
    df = spark.createDataFrame([("a|c",), (None,)], "genres string")
    got = df.select(fn.label_profile(F.col("genres"), ["a", "b", "c"])).collect()
    assert [r[0] for r in got] == ["101", None]


def test_rating_year_is_utc(spark):
    # Five hours behind UTC in the session zone of these tests.
    assert one(spark, 838985046, "bigint", fn.rating_year) == 1996
    assert one(spark, 978307200, "bigint", fn.rating_year) == 2001
    assert one(spark, 978307199, "bigint", fn.rating_year) == 2000
    assert one(spark, -1, "bigint", fn.rating_year) == 1969


@pytest.mark.parametrize("year, group", [(2015, 5), (2020, 0), (2023, -5), (1994, 25), (None, None)])
def test_age_group(spark, year, group):
    assert one(spark, year, "int", lambda x: fn.age_group(x, 2020)) == group


def test_missing_values_propagate_or_are_skipped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a double, p double")
    strict = df.agg(fn.rmse(F.col("a"), F.col("p")), mean_of(F.col("p")), min_of(F.col("p")), max_of(F.col("p")))
    assert strict.first()[:] == (None, None, None, None)
    loose = df.agg(
        fn.rmse(F.col("a"), F.col("p"), "skip"), mean_of(F.col("p"), "skip"), min_of(F.col("p"), "skip")
    )
    assert loose.first()[:] == (1.0, 2.0, 2.0)
    assert df.agg(fn.rmse(F.col("a"), F.lit(2.0))).first()[0] == 1.0
    with pytest.raises(ValueError):
        fn.rmse(F.col("a"), F.col("p"), "drop")
