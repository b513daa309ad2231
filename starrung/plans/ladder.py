"""The effect ladder: a mean plus one grouped-mean effect of the remaining residual per rung.

Work falls from rung to rung. Ratings are read three times while fitting: for
the item means, for the user means, and for sums per item and rating year once
both are known. All later keys depend on those two only, so the rest of the
ladder runs on ever shorter tables of residual sums, and scoring reads the
scored ratings once for all models together.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import fsum
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starrung.functions import MOVIE_LABELS, rating_year
from starrung.functions.measures import check_na
from starrung.operators.binning import assign_bins, quantile_breaks
from starrung.operators.effects import apply_effect, fit_effect_from_sums, label_effects, label_score
from starrung.operators.joins import heavy_keys, is_small, lookup
from starrung.plans.features import item_features
from starrung.workspace import ROW_OVERHEAD, Kept, Workspace, measured


@dataclass(frozen=True)
class Rung:
    """One effect: the column it is grouped by and the earlier effects taken off first."""

    name: str
    key: str
    after: tuple[str, ...]


# Item and user come first; these follow. Age and release are alternatives.
RUNGS = (
    Rung("group", "group", ("item", "user")),
    Rung("num", "num_genre", ("item", "user", "group")),
    Rung("age", "age_group", ("item", "user", "group", "num")),
    Rung("release", "release_year", ("item", "user", "group", "num")),
    Rung("sequel", "sequel", ("item", "user", "group", "num", "release")),
    Rung("year", "year_stamp", ("item", "user", "group", "num", "release", "sequel")),
)

# Effects of each model, in the order in which they are added up.
MODELS: dict[str, tuple[str, ...]] = {
    "1": (),
    "2": ("item",),
    "3": ("item", "user"),
    "4": ("item", "user", "group"),
    "5": ("item", "user", "group", "num"),
    "6a": ("item", "user", "group", "num", "age"),
    "6b": ("item", "user", "group", "num", "release"),
    "7": ("item", "user", "group", "num", "release", "sequel"),
    "8": ("item", "user", "group", "num", "release", "sequel", "year"),
}

LABEL_SCHEMA = "position int, label string, flag int, effect double, n bigint"

# Pairs of keys of two rungs that are fetched at most: labels, years and bins have few values each.
FETCHED_PAIRS = 100_000

# The models that are compared with each other.
COMPARED = ("1", "2", "3", "4", "5", "6b", "7", "8")

_FEATURES = ("profile", "num_genre", "release_year", "age_group", "sequel", "year_stamp")


def model_title(model: str) -> str:
    return " + ".join(("mean", *MODELS[model]))


def _effect(name: str) -> Column:
    return F.col(f"effect_{name}")


def _sum(columns: Iterable[Column]) -> Column:
    return reduce(add, columns, F.lit(0.0))


def _narrow(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id", "item_id", "rating", rating_year(F.col("ts")).alias("year_stamp"))


@dataclass(frozen=True)
class EffectLadder:
    """Settings of the ladder.

    ``binning`` is ``independent`` (label scores of the scored ratings are cut
    at their own quantiles) or ``train`` (at those of the fitted ratings). If
    one score covers several bins this is an error; with ``merge_bins`` the
    score goes to the first of them and the others stay empty, so that bin
    numbers mean the same for fitted and scored ratings.
    """

    as_of_year: int
    vocabulary: Sequence[str] = MOVIE_LABELS
    match: str = "substring"
    bins: int = 10
    binning: str = "independent"
    merge_bins: bool = False

    def __post_init__(self):
        if self.binning not in ("independent", "train"):
            raise ValueError(f"binning must be 'independent' or 'train', not {self.binning!r}")

    def features(self, ws: Workspace, items: DataFrame | Kept) -> Kept:
        """Features per item, to be given as ``items`` wherever they are needed again."""
        if isinstance(items, Kept):
            return items
        return ws.keep(item_features(items, self.vocabulary, self.as_of_year, self.match), "features")

    def score_breaks(self, ws: Workspace, weighted: Kept, score: Column) -> list[float]:
        """Breaks of a score over rows that each stand for ``n`` ratings."""
        return quantile_breaks(
            ws, weighted.df, score, self.bins, weight=F.col("n"), rows=weighted.rows, repeats=self.merge_bins
        )

    def fit(
        self,
        ws: Workspace,
        ratings: DataFrame,
        items: DataFrame | Kept,
        models: Sequence[str] = tuple(MODELS),
        start: LadderModel | None = None,
    ) -> LadderModel:
        """Fit the effects of ``models`` on ``user_id, item_id, rating, ts`` and ``item_id, title, genres``.

        ``ratings`` is read three times and should be a table, not a long query.
        ``start`` is an earlier fit on the same ratings, which is then extended.
        """
        rows = _narrow(ratings)
        wanted = {name for model in models for name in MODELS[model]}
        model = start or self._fit_item(ws, rows)
        if wanted - {"item"} and "user" not in model.effects:
            model = self._fit_user(ws, rows, model)
        if wanted - {"item", "user"}:
            if model.residuals is None:
                model = self._fit_groups(ws, rows, items, model)
            model = self._fit_rungs(ws, wanted, model)
        return model

    def _fit_item(self, ws: Workspace, rows: DataFrame) -> LadderModel:
        per_item = ws.keep(
            rows.groupBy("item_id").agg(
                F.sum("rating").alias("total"), F.count("rating").alias("known"), F.count(F.lit(1)).alias("n")
            ),
            "item-totals",
            **{name: F.sum(name) for name in ("total", "known", "n")},
        )
        n = per_item.totals["n"]
        if not n or per_item.totals["known"] < n:
            raise ValueError("ratings to fit must exist and must not be NULL")
        mean = per_item.totals["total"] / n
        by_item = per_item.df.select(
            "item_id", (F.col("total") / F.col("n") - F.lit(mean)).alias("effect_item"), "n"
        )
        return LadderModel(self, mean, {"item": replace(per_item, df=by_item)})

    def _fit_user(self, ws: Workspace, rows: DataFrame, model: LadderModel) -> LadderModel:
        residual = F.col("rating") - F.lit(model.mean) - _effect("item")
        user = ws.keep(
            apply_effect(rows.drop("year_stamp"), model.effects["item"], "item_id")
            .groupBy("user_id")
            .agg(F.avg(residual).alias("effect_user"), F.count(F.lit(1)).alias("n")),
            "effect-user",
        )
        return replace(model, effects={**model.effects, "user": user})

    def _fit_groups(self, ws: Workspace, rows: DataFrame, items: DataFrame | Kept, model: LadderModel) -> LadderModel:
        """Residual sums after item and user, first per feature combination, then per keys of the rungs."""
        residual = F.col("rating") - F.lit(model.mean) - _effect("user")
        sums = (
            apply_effect(rows, model.effects["user"], "user_id")
            .groupBy("item_id", "year_stamp")
            .agg(F.sum(residual).alias("total"), F.count(F.lit(1)).alias("n"))
        )
        sums = lookup(sums, _without_n(model.effects["item"]), ["item_id"], balanced=True)
        cells = ws.keep(
            lookup(sums, self.features(ws, items), ["item_id"], balanced=True)
            .groupBy(*_FEATURES)
            .agg(F.sum(F.col("total") - F.col("n") * _effect("item")).alias("total"), F.sum("n").alias("n")),
            "cells",
        )
        model = replace(model, label_rows=label_effects(cells.df, self.vocabulary).collect())
        breaks = self.score_breaks(ws, cells, model.score())
        residuals = (
            cells.df.withColumn("group", assign_bins(model.score(), breaks))
            .groupBy(*[rung.key for rung in RUNGS])
            .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        )
        return replace(model, breaks=breaks, residuals=residuals)

    def _fit_rungs(self, ws: Workspace, wanted: set[str], model: LadderModel) -> LadderModel:
        """The remaining effects, each from the residual sums less the effects before it.

        An effect needs of the earlier ones only how often their keys meet its own, so one grouping by pairs of
        keys serves all rungs. If there are more pairs than ``FETCHED_PAIRS``, each effect is a grouping of its own.
        """
        missing = [rung for rung in RUNGS if rung.name in wanted and rung.name not in model.effects]
        if not missing:
            return model
        pairs = _key_pairs(model.residuals, missing).limit(FETCHED_PAIRS + 1).collect()
        if len(pairs) > FETCHED_PAIRS:
            return self._fit_rungs_one_by_one(ws, wanted, model)
        effects = dict(model.effects)
        known = {rung.name: {None if row[0] is None else int(row[0]): row[1] for row in effects[rung.name].df.collect()}
                 for rung in RUNGS if rung.name in effects and any(rung.name in later.after for later in missing)}
        for rung in missing:
            known[rung.name], counts = _effect_of_pairs([row for row in pairs if row.rung == rung.name], known)
            key = model.residuals.schema[rung.key].dataType
            short = pa.table([pa.array(counts, pa.int64()).cast(to_arrow_type(key)),
                              pa.array(known[rung.name].values(), pa.float64()), pa.array(counts.values(), pa.int64())],
                             [rung.key, f"effect_{rung.name}", "n"])
            df = ws.spark.createDataFrame(short, f"{rung.key} {key.simpleString()}, effect_{rung.name} double, n bigint")
            nulls = frozenset([rung.key] if None in counts else [])
            effects[rung.name] = Kept(df, len(counts), len(counts) * (ROW_OVERHEAD + 24), nulls)
        return replace(model, effects=effects)

    def _fit_rungs_one_by_one(self, ws: Workspace, wanted: set[str], model: LadderModel) -> LadderModel:
        """The same effects by one grouping and one lookup for each."""
        effects, left = dict(model.effects), model.residuals
        for rung in RUNGS:
            if rung.name not in wanted:
                continue
            if rung.name not in effects:
                earlier = _sum(_effect(name) for name in rung.after if name not in ("item", "user"))
                residual = F.col("total") - F.col("n") * earlier
                effect = fit_effect_from_sums(left, rung.key, residual, rung.name)
                effects[rung.name] = ws.few(effect, f"effect-{rung.name}")
            if any(rung.name in later.after for later in RUNGS):
                left = apply_effect(left, effects[rung.name], rung.key)
        return replace(model, effects=effects)


def _key_pairs(residuals: DataFrame, rungs: Sequence[Rung]) -> DataFrame:
    """``rung, key, earlier, other, total, n``: residual sums per key of a rung (``earlier`` is NULL), and
    rows per pair of its key and that of an earlier rung, each as whole numbers."""
    keys = {rung.name: rung.key for rung in RUNGS}
    none = F.lit(None)
    wanted = [
        F.struct(
            F.lit(rung.name).alias("rung"), F.col(rung.key).cast("bigint").alias("key"),
            (none if name is None else F.lit(name)).cast("string").alias("earlier"),
            (none if name is None else F.col(keys[name])).cast("bigint").alias("other"),
        )
        for rung in rungs for name in (None, *[name for name in rung.after if name in keys])
    ]
    spread = residuals.select("total", "n", F.inline(F.array(*wanted)))
    return spread.groupBy("rung", "key", "earlier", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _effect_of_pairs(pairs: Sequence[Row], known: dict[str, dict]) -> tuple[dict, dict]:
    """Mean residual per key of one rung, and its rows per key, from its ``_key_pairs``."""
    counts = {row.key: row.n for row in pairs if row.earlier is None}
    parts: dict = {row.key: [row.total] for row in pairs if row.earlier is None}
    for row in pairs:
        if row.earlier is not None:
            parts[row.key].append(-row.n * known[row.earlier][row.other])
    return {key: fsum(part) / counts[key] for key, part in parts.items()}, counts


@dataclass(frozen=True)
class LadderModel:
    """A fitted ladder: the mean, one table per effect, label effects and score breaks."""

    ladder: EffectLadder
    mean: float
    effects: dict[str, Kept]
    # Three rows per label at most, so they are plain numbers, fixed before any score is computed.
    label_rows: list[Row] | None = None
    breaks: list[float] | None = None
    # Only while its workspace lasts: what later effects of an extended fit are computed from.
    residuals: DataFrame | None = None

    @property
    def labels(self) -> DataFrame:
        """Label effects: ``position, label, flag, effect, n``."""
        spark = self.effects["item"].df.sparkSession
        return spark.createDataFrame(self.label_rows, LABEL_SCHEMA)

    def score(self) -> Column:
        """Label score of a ``profile`` column."""
        effects = {(row.position, row.flag): row.effect for row in self.label_rows}
        return label_score("profile", effects, len(self.ladder.vocabulary))

    def _group(self, ws: Workspace, weighted: Kept) -> Column:
        """Bin of the score; with independent binning ``weighted`` (profile, n) supplies the breaks."""
        breaks = self.breaks
        if self.ladder.binning == "independent":
            breaks = self.ladder.score_breaks(ws, weighted, self.score())
        return assign_bins(self.score(), breaks)

    def item_groups(self, ws: Workspace, ratings: DataFrame, items: DataFrame | Kept) -> DataFrame:
        """``item_id, n, genre_score, group`` and the features of every item in ``ratings``."""
        rated = self._rated_items(ws, ratings, items)
        group = self._group(ws, rated)
        return rated.df.select("*", self.score().alias("genre_score"), group.alias("group"))

    def _rated_items(self, ws: Workspace, ratings: DataFrame, items: DataFrame | Kept) -> Kept:
        """Items of ``ratings`` with their number of rows ``n`` and features."""
        counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
        return ws.keep(lookup(counts, self.ladder.features(ws, items), ["item_id"], balanced=True), "rated-items")

    def transform(
        self, ws: Workspace, ratings: DataFrame, items: DataFrame | Kept, model: str = "8", output: str = "prediction"
    ) -> DataFrame:
        """``ratings`` with its effects and the prediction of a model; NULL where an effect is unknown."""
        names = MODELS[model]
        rated = self._rated_items(ws, ratings, items)
        table = lookup(rated.df, _without_n(self.effects["item"]), ["item_id"], balanced=True)
        if "group" in names:
            table = table.withColumn("group", self._group(ws, rated))
        for rung in RUNGS:
            if rung.name in names and rung.key != "year_stamp":
                table = apply_effect(table, self.effects[rung.name], rung.key)
        from_item = [f"effect_{name}" for name in names if name not in ("user", "year")]
        terms = ws.keep(table.select("item_id", *from_item), "item-terms")

        scored = ratings.withColumn("year_stamp", rating_year(F.col("ts")))
        if from_item:
            scored = lookup(
                scored, terms, ["item_id"], heavy=lambda: heavy_keys(rated.df, ["item_id"], weight=F.col("n"))
            )
            if not is_small(terms):
                scored = ws.table(scored, "with-items")
        if "user" in names:
            scored = apply_effect(scored, self.effects["user"], "user_id")
            if not is_small(self.effects["user"]):
                scored = ws.table(scored, "with-users")
        if "year" in names:
            scored = apply_effect(scored, self.effects["year"], "year_stamp")
        prediction = reduce(add, [_effect(name) for name in names], F.lit(self.mean))
        return scored.withColumn(output, prediction)

    def evaluate(
        self,
        ws: Workspace,
        ratings: DataFrame,
        items: DataFrame | Kept,
        models: Sequence[str] = COMPARED,
        na: str = "propagate",
    ) -> DataFrame:
        """``model, title, rmse, scored`` of several models from one reading of ``ratings``.

        Squared errors are kept as count, sum and sum of squares per group of
        ratings that share all later effects. Their sum is that of larger
        squares, so an RMSE below about 1e-7 of the effects is noise.
        """
        check_na(na)
        needed = {name for model in models for name in MODELS[model]}
        kept = self._error_cells(ws, _narrow(ratings), items, needed)
        cells = kept.df
        if "group" in needed:
            cells = cells.withColumn("group", self._group(ws, kept))
        for rung in RUNGS:
            if rung.name in needed:
                cells = apply_effect(cells, self.effects[rung.name], rung.key)
        totals = []
        for model in models:
            names = MODELS[model]
            level = str(min(len(names), 2) + 1)
            later = _sum(_effect(name) for name in names[2:])
            seen = F.when(later.isNotNull(), F.col(f"n{level}"))
            error = F.col(f"q{level}") - 2 * later * F.col(f"s{level}") + F.col(f"n{level}") * later * later
            totals += [F.sum(error).alias(f"sse_{model}"), F.sum(seen).alias(f"seen_{model}")]
        wide = cells.agg(F.sum("n").alias("n"), *totals)
        rows = []
        for model in models:
            seen = F.coalesce(F.col(f"seen_{model}"), F.lit(0))
            mse = F.greatest(F.lit(0.0), F.col(f"sse_{model}")) / F.nullif(seen, F.lit(0))
            complete = F.lit(True) if na == "skip" else seen == F.col("n")
            rows.append(
                F.struct(
                    F.lit(model).alias("model"),
                    F.lit(model_title(model)).alias("title"),
                    F.when(complete, F.sqrt(mse)).alias("rmse"),
                    seen.alias("scored"),
                )
            )
        return wide.select(F.inline(F.array(*rows)))

    def _error_cells(self, ws: Workspace, rows: DataFrame, items: DataFrame | Kept, needed: set[str]) -> Kept:
        """Residual moments after the mean (1), the item (2) and the user (3) effect, per feature combination."""
        residual = F.col("rating") - F.lit(self.mean)
        moments = [F.count(F.lit(1)).alias("n"), *_moments("1", residual)]
        if "user" in needed:
            rows = apply_effect(rows, self.effects["user"], "user_id")
            moments += _moments("3", residual - _effect("user"))
        per_item = rows.groupBy("item_id", "year_stamp").agg(*moments)
        with_item = lookup(per_item, _without_n(self.effects["item"]), ["item_id"], balanced=True)
        keys = [key for key in _FEATURES if key in _keys_of(needed)]
        listed = with_item
        if set(keys) - {"year_stamp"}:
            listed = lookup(with_item, self.ladder.features(ws, items), ["item_id"], balanced=True)
        sums = [F.sum(c).alias(c) for c in ("n", "n1", "s1", "q1")] + _shifted("1", "2", _effect("item"))
        if "user" in needed:
            sums += _shifted("3", "3", _effect("item"))
        return ws.keep(listed.groupBy(*keys).agg(*sums), "error-cells")

    def save(self, path: str) -> None:
        """Write the model below ``path`` as Parquet tables."""
        for name, table in self.effects.items():
            table.df.write.parquet(f"{path}/effect-{name}")
        if self.label_rows:
            self.labels.write.parquet(f"{path}/effect-label")
        spark = self.effects["item"].df.sparkSession
        ladder = self.ladder
        settings = (
            self.mean, self.breaks, ladder.as_of_year, list(ladder.vocabulary), ladder.match, ladder.bins,
            ladder.binning, ladder.merge_bins, list(self.effects), bool(self.label_rows),
        )
        spark.createDataFrame(
            [settings],
            "mean double, breaks array<double>, as_of_year int, vocabulary array<string>,"
            " match string, bins int, binning string, merge_bins boolean, effects array<string>, labelled boolean",
        ).write.parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LadderModel:
        s = spark.read.parquet(f"{path}/settings").first()
        ladder = EffectLadder(s.as_of_year, tuple(s.vocabulary), s.match, s.bins, s.binning, s.merge_bins)

        effects = {name: measured(spark.read.parquet(f"{path}/effect-{name}")) for name in s.effects}
        labels = spark.read.parquet(f"{path}/effect-label").collect() if s.labelled else None
        breaks = None if s.breaks is None else list(s.breaks)
        return cls(ladder, s.mean, effects, labels, breaks)


def _keys_of(needed: set[str]) -> set[str]:
    """Feature columns that these effects are looked up by."""
    return {"profile" if rung.name == "group" else rung.key for rung in RUNGS if rung.name in needed}


def _without_n(effect: Kept) -> Kept:
    return replace(effect, df=effect.df.drop("n"))


def _moments(level: str, residual: Column) -> list[Column]:
    return [
        F.count(residual).alias(f"n{level}"),
        F.coalesce(F.sum(residual), F.lit(0.0)).alias(f"s{level}"),
        F.coalesce(F.sum(residual * residual), F.lit(0.0)).alias(f"q{level}"),
    ]


def _shifted(source: str, target: str, shift: Column) -> list[Column]:
    """Moments of the residual minus ``shift``, over the groups where it is known."""
    n, s, q = F.col(f"n{source}"), F.col(f"s{source}"), F.col(f"q{source}")

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(shift.isNotNull(), value)), F.lit(0)).alias(f"{name}{target}")

    return [total(n, "n"), total(s - n * shift, "s"), total(q - 2 * shift * s + n * shift * shift, "q")]
