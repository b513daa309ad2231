"""Named queries over the star-schema tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starrung.functions import label_count, label_flags, rating_year, release_year, sequel_flag
from starrung.functions.calendar import age_group
from starrung.functions.measures import mean_of, rmse
from starrung.operators.binning import histogram
from starrung.operators.effects import apply_effect, fit_effect, global_mean
from starrung.operators.explore import (
    count_per_key,
    displayed,
    distinct_counts,
    frequencies,
    label_vocabulary,
    preview,
    sparse_sample,
    value_range,
)
from starrung.operators.joins import lookup, natural_anti_join, semi_join
from starrung.operators.split import sample_keys, shuffle_keys
from starrung.plans.features import rating_features
from starrung.plans.ladder import MODELS
from starrung.plans.study import Study
from starrung.sources.delimited import SEPARATOR, describe_schema, read_items, read_ratings
from starrung.sources.star import VIEW_LABELS, items_of, joined, ratings_of
from starrung.workspace import hadoop_path

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_YEAR = 2020
DISPLAY_DIGITS = 6


def _round(value: Column | str) -> Column:
    """Six decimals, as in the printed tables.

    Means of few values often end in an exact 5 at the seventh decimal; rounding
    to twelve first takes off the noise of the summation that would decide there.
    """
    return F.round(F.round(value, 12), 6)


_studies: dict[tuple, tuple[list, Study]] = {}


def _study(spark: SparkSession, sf_dir: str, sparse: bool = False) -> Study:
    """The study of a directory, made once per session so that queries share its splits and fits.

    It is made anew if its tables are gone or the files it was made from have
    changed; the tables of the one before are deleted.
    """
    key = (spark.sparkContext.applicationId, sf_dir, sparse)
    versions = _versions(spark, sf_dir)
    known, study = _studies.get(key, (None, None))
    if study is None or known != versions or study.ws.spark is not spark or not study.ws.intact():
        if study is not None and study.ws.spark is spark:
            study.ws.release()
        study = Study.of_tables(spark, sf_dir, sparse=sparse, as_of_year=AS_OF_YEAR)
        _studies[key] = versions, study
    return study


def _versions(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """Size and time of change of the files that a study reads."""
    found = []
    for name in ("lineitem", "orders", "part"):
        path, files = hadoop_path(spark, f"{sf_dir}/{name}.parquet")
        found.append((files.getContentSummary(path).getLength(), files.getFileStatus(path).getModificationTime()))
    return found


def forget_studies() -> None:
    """Delete the tables that queries have shared so far; results not read yet are lost."""
    for _, study in _studies.values():
        study.ws.release()
    _studies.clear()


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(_study(spark, sf_dir).ws, ratings_of(spark, sf_dir), items_of(spark, sf_dir))


# Sources


def q_read_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _study(spark, sf_dir).ws.path("ratings.dat")
    fields = [F.col(c).cast("string") for c in ("user_id", "item_id", "rating", "ts")]
    ratings_of(spark, sf_dir).select(F.concat_ws(SEPARATOR, *fields)).write.text(path)
    return read_ratings(spark, path)


def q_read_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _study(spark, sf_dir).ws.path("items.dat")
    fields = [F.col("item_id").cast("string"), F.col("title"), F.col("genres")]
    items_of(spark, sf_dir).select(F.concat_ws(SEPARATOR, *fields)).write.text(path)
    return read_items(spark, path)


def q_describe_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A lookup of items with one row per id leaves the number of ratings as it is.
    return describe_schema(_joined(spark, sf_dir), rows=ratings_of(spark, sf_dir))


def q_ratings_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select("row_key", "user_id", "item_id", "rating", "title", "genres")


# Features


def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _study(spark, sf_dir).ws
    wide = rating_features(ws, ratings_of(spark, sf_dir), items_of(spark, sf_dir), VIEW_LABELS, AS_OF_YEAR)
    return wide.select("row_key", "num_genre", "release_year", "age_group", "sequel", "year_stamp")


def q_label_flags(spark: SparkSession, sf_dir: str, match: str = "substring") -> DataFrame:
    per_item = items_of(spark, sf_dir).select("item_id", *label_flags(F.col("genres"), VIEW_LABELS, match))
    rows = ratings_of(spark, sf_dir).select("row_key", "item_id")
    return lookup(rows, per_item, ["item_id"], ws=_study(spark, sf_dir).ws).drop("item_id")


def q_label_flags_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_label_flags(spark, sf_dir, "token")


def q_label_flags_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_label_flags(spark, sf_dir, "regex")


def q_label_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(spark, sf_dir).select("item_id", label_count(F.col("genres")).alias("num_genre"))


def q_release_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(spark, sf_dir).select("item_id", release_year(F.col("title")).alias("release_year"))


def q_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = age_group(release_year(F.col("title")), AS_OF_YEAR)
    return items_of(spark, sf_dir).select("item_id", group.alias("age_group"))


def q_sequel_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(spark, sf_dir).select("item_id", sequel_flag(F.col("title")).alias("sequel"))


def q_rating_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings_of(spark, sf_dir).select("row_key", rating_year(F.col("ts")).alias("year_stamp"))


# Splits


def _sides(**sides: DataFrame) -> DataFrame:
    parts = [df.select("row_key", F.lit(side).alias("side")) for side, df in sides.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def q_split_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = _study(spark, sf_dir).outer
    return _sides(work=outer.train, validation=outer.holdout)


def q_split_holdout_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = _study(spark, sf_dir, sparse=True).outer
    return _sides(work=outer.train, validation=outer.holdout)


def q_split_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = _study(spark, sf_dir).inner
    return _sides(train=inner.train, test=inner.holdout)


def q_split_test_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = _study(spark, sf_dir, sparse=True).inner
    return _sides(train=inner.train, test=inner.holdout)


def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir).split_counts()


def q_split_counts_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir, sparse=True).split_counts()


def q_holdout_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir, sparse=True)
    drawn = study.outer.drawn
    rest = study.ws.table(natural_anti_join(study.ws, study.ratings, drawn), "rest")
    known_item = semi_join(study.ws, drawn, rest, "item_id")
    return semi_join(study.ws, known_item, rest, "user_id")


def q_holdout_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir, sparse=True)
    return natural_anti_join(study.ws, study.outer.drawn, study.outer.holdout)


def q_sample_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_keys(_study(spark, sf_dir).outer.train, "user_id", 10, seed=7)


def q_shuffle_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    return shuffle_keys(study.ws, study.outer.train, "item_id", seed=7)


# Exploration


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    return study.joined(preview(study.outer.train, ["row_key"]))


def q_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _study(spark, sf_dir).outer.train
    return distinct_counts(work, unique_users="user_id", unique_items="item_id")


def q_ratings_per_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_key(_study(spark, sf_dir).outer.train, "item_id")


def q_ratings_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_key(_study(spark, sf_dir).outer.train, "user_id")


def _rounded_edges(histogram_of: DataFrame) -> DataFrame:
    return histogram_of.select("bin", _round("lower").alias("lower"), _round("upper").alias("upper"), "count")


def q_hist_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    counts = count_per_key(study.outer.train, "item_id")
    return _rounded_edges(histogram(study.ws, counts, F.col("num_ratings"), 30))


def q_hist_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    counts = count_per_key(study.outer.train, "user_id")
    return _rounded_edges(histogram(study.ws, counts, F.col("num_ratings"), 40))


def _train_items(study: Study) -> DataFrame:
    """Items rated in train with their number of ratings and their features."""
    counts = count_per_key(study.inner.train, "item_id", "n")
    return lookup(counts, study.features, ["item_id"], balanced=True)


def q_hist_release_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    years = histogram(study.ws, _train_items(study), F.col("release_year"), weight=F.col("n"))
    return _rounded_edges(years)


def q_release_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _train_items(_study(spark, sf_dir))
    strict = value_range(items, "release_year").toDF("lowest", "highest").withColumn("na", F.lit("propagate"))
    known = value_range(items, "release_year", "skip").toDF("lowest", "highest").withColumn("na", F.lit("skip"))
    return strict.unionByName(known)


def q_freq_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequencies(_train_items(_study(spark, sf_dir)), "age_group", weight="n")


def q_freq_sequel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequencies(_train_items(_study(spark, sf_dir)), "sequel", weight="n")


def q_label_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    rated = semi_join(study.ws, study.items, study.outer.train, "item_id")
    return label_vocabulary(rated, "genres")


def q_sequel_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    sequels = study.joined(study.inner.train).where(sequel_flag(F.col("title")))
    return preview(sequels, ["row_key"], 20).select("title")


def q_sparse_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    return sparse_sample(study.ws, study.outer.train, "user_id", "item_id", "rating", rows=10, columns=4, seed=7)


# Effects and models


def q_apply_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _study(spark, sf_dir).ws
    wide = rating_features(ws, ratings_of(spark, sf_dir), items_of(spark, sf_dir), VIEW_LABELS, AS_OF_YEAR)
    rows = ws.table(wide.select("row_key", "rating", "release_year"), "rows")
    residual = F.col("rating") - F.lit(global_mean(rows))
    effect = ws.keep(fit_effect(rows, "release_year", residual, "release"), "effect")
    return apply_effect(rows, effect, "release_year").select(
        "row_key", "release_year", _round("effect_release").alias("effect_release")
    )


def _effect_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = next(m for m, names in MODELS.items() if name in names)
        effect = _study(spark, sf_dir).fit([model]).effects[name].df
        return effect.withColumn(f"effect_{name}", _round(f"effect_{name}"))

    return query


def q_label_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _study(spark, sf_dir).fit(["4"]).labels
    return labels.select("position", "label", "flag", _round("effect").alias("effect"), "n")


def q_label_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    score = study.fit(["4"]).score()
    return study.features.df.select("item_id", _round(score).alias("genre_score"))


def q_score_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    breaks = _study(spark, sf_dir).fit(["4"]).breaks
    rows = list(enumerate(breaks))
    return spark.createDataFrame(rows, "position int, score_break double").select(
        "position", _round("score_break").alias("score_break")
    )


def q_score_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    model = study.fit(["4"])
    parts = [
        model.item_groups(study.ws, ratings, study.features).withColumn("side", F.lit(side))
        for side, ratings in (("train", study.inner.train), ("test", study.inner.holdout))
    ]
    return parts[0].unionByName(parts[1]).select("side", "item_id", "group", "n")


def q_score_group_train_binning(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    model = study.fit(["4"])
    model = replace(model, ladder=replace(model.ladder, binning="train"))
    return model.item_groups(study.ws, study.inner.holdout, study.features).select("item_id", "group", "n")


def q_freq_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    groups = study.fit(["4"]).item_groups(study.ws, study.inner.train, study.features)
    return frequencies(groups, "group", weight="n")


def q_hist_label_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = _study(spark, sf_dir)
    groups = study.fit(["4"]).item_groups(study.ws, study.inner.train, study.features)
    return _rounded_edges(histogram(study.ws, groups, F.col("genre_score"), weight=F.col("n")))


def _model_query(model: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _study(spark, sf_dir).compare([model]).select("model", _round("rmse").alias("rmse"), "scored")

    return query


def q_rmse_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir).compare().select("model", "title", _round("rmse").alias("rmse"))


def q_rmse_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of errors as it is printed, by significant digits."""
    study = _study(spark, sf_dir)
    compared = study.compare().select("model", "title", F.round("rmse", 12).alias("rmse"))
    return displayed(study.ws, compared, DISPLAY_DIGITS)


def _rmse_unrepaired(spark: SparkSession, sf_dir: str, na: str) -> DataFrame:
    """Errors on a hold-out as it was drawn: some of its users and items are not in train, so their effects are unknown."""
    study = _study(spark, sf_dir, sparse=True)
    models = ["1", "2", "3"]
    scored = study.fit(models).evaluate(study.ws, study.inner.drawn, study.features, models, na=na)
    return scored.select("model", _round("rmse").alias("rmse"), "scored")


def q_rmse_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of known predictions only."""
    return _rmse_unrepaired(spark, sf_dir, "skip")


def q_rmse_unrepaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unknown prediction makes the error of its model unknown; ``scored`` tells how many are known."""
    return _rmse_unrepaired(spark, sf_dir, "propagate")


def q_rmse_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = rmse(F.col("rating"), F.col("prediction"))
    return _study(spark, sf_dir).final_predictions().agg(_round(error).alias("rmse"))


def q_final_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir).final_score().select("model", _round("rmse").alias("rmse"), "scored")


def q_final_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _study(spark, sf_dir).final_predictions()
    return scored.select("row_key", "rating", _round("prediction").alias("prediction"))


def q_global_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings_of(spark, sf_dir).agg(_round(mean_of(F.col("rating"))).alias("average"))


MODEL_QUERIES = {
    "model1_mean": "1",
    "model2_item": "2",
    "model3_user": "3",
    "model4_group": "4",
    "model5_num": "5",
    "model6a_age": "6a",
    "model6b_release": "6b",
    "model7_sequel": "7",
    "model8_year": "8",
}

EFFECT_QUERIES = ("item", "user", "group", "num", "age", "release", "sequel", "year")


def _once(name: str, query: Query) -> Query:
    """The query, planned once per study: a repeated call writes no further tables."""

    @wraps(query)
    def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
        results = _study(spark, sf_dir).results
        if name not in results:
            results[name] = query(spark, sf_dir)
        return results[name]

    return planned


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")
    }
    found.update({f"effect_{name}": _effect_query(name) for name in EFFECT_QUERIES})
    found.update({name: _model_query(model) for name, model in MODEL_QUERIES.items()})
    return {name: _once(name, query) for name, query in found.items()}
