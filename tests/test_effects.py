import pytest
from conftest import rows
from pyspark.sql import functions as F

from starrung.functions import label_profile
from starrung.operators.effects import (
    apply_effect,
    fit_effect,
    fit_effect_from_sums,
    global_mean,
    label_effects,
    label_score,
)

RATINGS = [(1, 4.0, "a|b"), (1, 2.0, "a"), (2, 5.0, None), (None, 1.0, "b"), (None, 2.0, "c")]


@pytest.fixture
def ratings(spark):
    return spark.createDataFrame(RATINGS, "k int, rating double, genres string")


def test_global_mean(ratings):
    assert global_mean(ratings) == pytest.approx(2.8)
    with_null = ratings.withColumn("rating", F.when(F.col("k") == 1, F.col("rating")))
    assert global_mean(with_null) is None
    assert global_mean(with_null, na="skip") == 3.0


def test_fit_and_apply_with_null_keys(ws, ratings):
    effect = fit_effect(ratings, "k", F.col("rating") - 2, "k")
    assert rows(effect) == [(None, -0.5, 2), (1, 1.0, 2), (2, 3.0, 1)]
    expected = [(None, -0.5), (None, -0.5), (1, 1.0), (1, 1.0), (2, 3.0)]
    assert rows(apply_effect(ratings, effect, "k").select("k", "effect_k")) == expected
    assert rows(apply_effect(ratings, ws.keep(effect, "e"), "k").select("k", "effect_k")) == expected


def test_unseen_key_gets_null(spark, ratings):
    effect = fit_effect(ratings.where("k = 1"), "k", F.col("rating"), "k")
    assert apply_effect(ratings, effect, "k").where("effect_k is null").count() == 3


def test_effect_of_null_residual(ratings):
    df = ratings.withColumn("rating", F.when(F.col("genres").isNotNull(), F.col("rating")))
    assert rows(fit_effect(df, "k", F.col("rating"), "k"))[2] == (2, None, 1)
    partly = df.withColumn("k", F.lit(7))
    assert rows(fit_effect(partly, "k", F.col("rating"), "k")) == [(7, None, 5)]
    assert rows(fit_effect(partly, "k", F.col("rating"), "k", "skip")) == [(7, 2.25, 5)]


def test_effect_from_sums_equals_effect_from_rows(ratings):
    cells = ratings.groupBy("k", "genres").agg(F.sum("rating").alias("total"), F.count(F.lit(1)).alias("n"))
    assert rows(fit_effect_from_sums(cells, "k", F.col("total"), "k")) == rows(
        fit_effect(ratings, "k", F.col("rating"), "k")
    )


def test_fused_label_effects_equal_separate_groupings(ratings):
    vocabulary = ["a", "b", "c"]
    profile = label_profile(F.col("genres"), vocabulary)
    cells = ratings.select(profile.alias("profile"), F.col("rating").alias("total"), F.lit(1).alias("n"))
    fused = {(r.label, r.flag): (r.effect, r.n) for r in label_effects(cells, vocabulary).collect()}
    separate = {}
    for label in vocabulary:
        flag = F.contains(F.col("genres"), F.lit(label)).cast("int").alias("flag")
        for r in ratings.groupBy(flag).agg(F.avg("rating").alias("e"), F.count(F.lit(1)).alias("n")).collect():
            separate[label, r.flag] = (r.e, r.n)
    assert fused == separate


def test_label_score_adds_the_effect_of_every_flag(spark):
    df = spark.createDataFrame([("10",), ("01",), (None,)], "profile string")
    effects = {(1, 1): 1.0, (1, 0): 2.0, (1, None): 4.0, (2, 0): 8.0, (2, None): 16.0}
    got = df.select(label_score("profile", effects, 2)).collect()
    assert [r[0] for r in got] == [9.0, None, 20.0]
