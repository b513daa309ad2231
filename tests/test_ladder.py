from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starrung import EffectLadder, LadderModel
from starrung.functions import rmse
from starrung.operators import joins
from starrung.operators.effects import apply_effect, fit_effect
from starrung.plans import ladder
from starrung.plans.features import rating_features
from starrung.plans.ladder import COMPARED, MODELS, RUNGS
from starrung.sources.star import VIEW_LABELS

# RMSE per model on sf0.001, computed beforehand without Spark.
TRAIN_RMSE = {"1": 1.344285, "2": 0.972441, "3": 0.736889, "4": 0.735320, "5": 0.735163, "6a": 0.734318,
              "6b": 0.732504, "7": 0.732498, "8": 0.655932}
TEST_RMSE = {"1": 1.353541, "2": 1.040411, "3": 0.814162, "4": 0.811466, "5": 0.811999, "6a": 0.812176,
             "6b": 0.810621, "7": 0.810757, "8": 0.719295}


def errors(df):
    return {r.model: r.rmse for r in df.collect()}


def test_test_rmse(dense):
    got = errors(dense.model.evaluate(dense.ws, dense.inner.holdout, dense.features, list(MODELS)))
    assert got == pytest.approx(TEST_RMSE, abs=1e-6)


def test_train_rmse_never_rises(dense):
    got = errors(dense.model.evaluate(dense.ws, dense.inner.train, dense.features, list(MODELS)))
    assert got == pytest.approx(TRAIN_RMSE, abs=1e-6)
    ladder = [got[m] for m in COMPARED]
    assert ladder == sorted(ladder, reverse=True)


@pytest.mark.parametrize("model", ["1", "2", "3", "4", "6a", "8"])
def test_evaluation_equals_rmse_of_row_predictions(dense, model):
    scored = dense.model.transform(dense.ws, dense.inner.holdout, dense.features, model)
    direct = scored.agg(rmse(F.col("rating"), F.col("prediction"))).first()[0]
    assert direct == pytest.approx(TEST_RMSE[model], abs=1e-6)


def test_shuffled_lookups_give_the_same_model(dense, no_broadcast):
    model = dense.ladder.fit(dense.ws, dense.inner.train, dense.features)
    got = errors(model.evaluate(dense.ws, dense.inner.holdout, dense.features, list(MODELS)))
    assert got == pytest.approx(TEST_RMSE, abs=1e-6)
    scored = model.transform(dense.ws, dense.inner.holdout, dense.features)
    assert scored.agg(rmse(F.col("rating"), F.col("prediction"))).first()[0] == pytest.approx(TEST_RMSE["8"], abs=1e-6)


def test_effects_equal_stepwise_grouped_means(dense):
    """The ladder on sums against the same ladder row by row."""
    model, ws = dense.model, dense.ws
    wide = rating_features(ws, dense.inner.train, dense.items, VIEW_LABELS, 2020)
    groups = model.item_groups(ws, dense.inner.train, dense.features).select("item_id", "group")
    wide = ws.table(wide.join(groups, "item_id"), "wide")
    residual = F.col("rating") - F.lit(model.mean)
    for name, key in (("item", "item_id"), ("user", "user_id")):
        effect = ws.keep(fit_effect(wide, key, residual, name), name)
        assert dict((r[0], r[1]) for r in effect.df.collect()) == pytest.approx(
            dict((r[0], r[1]) for r in model.effects[name].df.collect()), abs=1e-9
        )
        wide = ws.table(apply_effect(wide, effect, key), "wide")
        residual = residual - F.col(f"effect_{name}")
    for rung in RUNGS:
        left = F.col("rating") - F.lit(model.mean)
        for name in rung.after:
            left = left - F.col(f"effect_{name}")
        effect = ws.keep(fit_effect(wide, rung.key, left, rung.name), rung.name)
        assert {r[0]: (r[1], r[2]) for r in effect.df.collect()} == {
            r[0]: (pytest.approx(r[1], abs=1e-9), r[2]) for r in model.effects[rung.name].df.collect()
        }
        wide = ws.table(apply_effect(wide, effect, rung.key), "wide")
        # What is left has mean zero on every level of the key.
        rest = wide.groupBy(rung.key).agg(F.avg(left - F.col(f"effect_{rung.name}")).alias("m"))
        assert rest.agg(F.max(F.abs("m"))).first()[0] < 1e-9


def refit(study, models):
    return study.ladder.fit(study.ws, study.inner.train, study.features, models)


def test_holdout_ratings_do_not_change_the_fit(dense):
    changed = dense.inner.holdout.withColumn("rating", F.lit(5.0))
    assert errors(dense.model.evaluate(dense.ws, changed, dense.features)) != pytest.approx(TEST_RMSE, abs=0.01)
    again = refit(dense, ["3"])
    assert dict(r[:2] for r in again.effects["user"].df.collect()) == pytest.approx(
        dict(r[:2] for r in dense.model.effects["user"].df.collect()), abs=1e-9
    )


def test_partial_fit_has_only_the_needed_effects(dense):
    assert set(refit(dense, ["2"]).effects) == {"item"}
    assert set(refit(dense, ["6b"]).effects) == {"item", "user", "group", "num", "release"}
    assert errors(dense.compare(["5"])) == pytest.approx({"5": TEST_RMSE["5"]}, abs=1e-6)


def test_a_fit_can_be_extended(dense):
    small = refit(dense, ["2"])
    item = small.effects["item"]
    for models, more in ((["3"], {"user"}), (["5"], {"group", "num"}), (["6a"], {"age"}),
                         (["8"], {"release", "sequel", "year"}), (["4"], set())):
        small_names = set(small.effects)
        small = dense.ladder.fit(dense.ws, dense.inner.train, dense.features, models, start=small)
        assert set(small.effects) - small_names == more
    assert small.effects["item"] is item
    got = errors(small.evaluate(dense.ws, dense.inner.holdout, dense.features, list(MODELS)))
    assert got == pytest.approx(TEST_RMSE, abs=1e-6)


def test_train_binning_equals_independent_binning_on_train(dense):
    by_train = replace(dense.model, ladder=replace(dense.ladder, binning="train"))
    own = rows(dense.model.item_groups(dense.ws, dense.inner.train, dense.features).select("item_id", "group"))
    assert rows(by_train.item_groups(dense.ws, dense.inner.train, dense.features).select("item_id", "group")) == own
    test = by_train.item_groups(dense.ws, dense.inner.holdout, dense.features)
    assert test.where("group < 1 or group > 10").count() == 0
    with pytest.raises(ValueError):
        EffectLadder(2020, binning="own")


def test_unseen_levels(spark, dense):
    """A rating year, a user or an item that train does not have makes the error unknown, or is skipped."""
    late = dense.inner.holdout.limit(1).withColumn("ts", F.lit(2_000_000_000).cast("bigint"))
    test = dense.inner.holdout.unionByName(late)
    strict = errors(dense.model.evaluate(dense.ws, test, dense.features, ["7", "8"]))
    assert strict["7"] is not None and strict["8"] is None
    loose = dense.model.evaluate(dense.ws, test, dense.features, ["8"], na="skip").first()
    assert loose.scored == test.count() - 1
    assert loose.rmse == pytest.approx(TEST_RMSE["8"], abs=0.01)
    stranger = dense.inner.holdout.limit(1).withColumn("user_id", F.lit(-1).cast("bigint"))
    strict = errors(dense.model.evaluate(dense.ws, dense.inner.holdout.unionByName(stranger), dense.features, ["2", "3"]))
    assert strict["2"] is not None and strict["3"] is None
    unknown = dense.inner.holdout.limit(1).withColumn("item_id", F.lit(-1_000_000).cast("bigint"))
    mixed = dense.inner.holdout.unionByName(unknown)
    strict = errors(dense.model.evaluate(dense.ws, mixed, dense.features, ["1", "2", "8"]))
    assert strict["1"] is not None and strict["2"] is None and strict["8"] is None
    assert dense.model.transform(dense.ws, mixed, dense.features).where("prediction is null").count() == 1


def test_null_ratings_are_refused(dense):
    with pytest.raises(ValueError):
        dense.ladder.fit(dense.ws, dense.inner.train.withColumn("rating", F.lit(None).cast("double")), dense.features)
    with pytest.raises(ValueError):
        dense.ladder.fit(dense.ws, dense.inner.train.limit(0), dense.features)


def test_save_and_load(spark, dense, tmp_path):
    dense.model.save(str(tmp_path / "model"))
    loaded = LadderModel.load(spark, str(tmp_path / "model"))
    assert loaded.ladder == dense.ladder
    got = errors(loaded.evaluate(dense.ws, dense.inner.holdout, dense.features, list(MODELS)))
    assert got == pytest.approx(TEST_RMSE, abs=1e-6)
    refit(dense, ["2"]).save(str(tmp_path / "small"))
    small = LadderModel.load(spark, str(tmp_path / "small"))
    assert set(small.effects) == {"item"} and small.label_rows is None and small.breaks is None


def test_refit_on_sparse_ratings(sparse):
    final = sparse.final_score().first()
    assert final.scored == 580 and final.rmse == pytest.approx(0.826273, abs=1e-6)


def test_plan_of_scoring(dense):
    """Row predictions: one reading of the ratings, small tables broadcast, no Python, no nested loops."""
    scored = dense.model.transform(dense.ws, dense.inner.holdout, dense.features)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    for bad in ("Cartesian", "NestedLoop", "Python", "SortMergeJoin"):
        assert bad not in plan
    assert plan.count("held_out") and plan.count("FileScan parquet") <= 10


def test_fit_passes_over_the_ratings(dense, monkeypatch):
    """Lookups of item and user tables are the only joins on ratings."""
    seen = []
    original = joins.null_safe_join

    def spy(left, right, keys, how, nulls=None):
        seen.append(tuple(keys))
        return original(left, right, keys, how, nulls)

    monkeypatch.setattr(joins, "null_safe_join", spy)
    dense.ladder.fit(dense.ws, dense.inner.train, dense.features)
    assert seen[:2] == [("item_id",), ("user_id",)]
    assert len(seen) <= 8


def test_effects_from_pairs_of_keys_equal_those_fitted_one_by_one(dense, monkeypatch):
    """Also where a fit with some of the effects is extended by the others."""
    def fitted(start=None):
        model = dense.ladder.fit(dense.ws, dense.inner.train, dense.features, start=start)
        return {rung.name: {r[0]: tuple(r[1:]) for r in model.effects[rung.name].df.collect()} for rung in RUNGS}

    at_once = fitted()
    extended = fitted(dense.ladder.fit(dense.ws, dense.inner.train, dense.features, ["5"]))
    monkeypatch.setattr(ladder, "FETCHED_PAIRS", 0)
    one_by_one = fitted()
    for other in (at_once, extended):
        for name, effects in one_by_one.items():
            assert set(other[name]) == set(effects)
            for key, (effect, n) in effects.items():
                assert other[name][key] == (pytest.approx(effect, abs=1e-9), n)
