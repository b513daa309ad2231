"""One analysis from raw tables to scores: split, fit on train, compare on test, refit, score the hold-out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starrung.operators.split import QUARTILE_STRATA, Split, quartile_stratum, split_and_repair
from starrung.plans.ladder import COMPARED, MODELS, EffectLadder, LadderModel
from starrung.sources.star import VIEW_LABELS, items_of, joined, ratings_of
from starrung.workspace import Kept, Workspace

KNOWN_KEYS = ("item_id", "user_id")


class Study:
    """Steps of the analysis, each computed when first asked for and kept for later steps.

    Two hold-outs are drawn: a tenth of all ratings for the final score, whose
    unusable rows go back, and a fifth of the rest for comparing models, whose
    unusable rows are dropped.
    """

    def __init__(
        self,
        ws: Workspace,
        ratings: DataFrame,
        items: DataFrame,
        ladder: EffectLadder,
        row_key: str = "row_key",
        seeds: tuple[int, int] = (1, 42),
        fractions: tuple[float, float] = (0.1, 0.2),
    ):
        self.ws, self.source, self.items, self.ladder = ws, ratings, items, ladder
        self.row_key, self.seeds, self.fractions = row_key, seeds, fractions
        # What callers have derived from the study and want to use again.
        self.results: dict[str, DataFrame] = {}
        self._fitted: LadderModel | None = None
        self._refitted: LadderModel | None = None

    @classmethod
    def of_tables(
        cls, spark: SparkSession, sf_dir: str, ws: Workspace | None = None, sparse: bool = False, **settings
    ) -> Study:
        """The study of the star-schema tables below ``sf_dir``."""
        ladder = EffectLadder(**{"as_of_year": 2020, "vocabulary": VIEW_LABELS, **settings})
        return cls(ws or Workspace(spark), ratings_of(spark, sf_dir, sparse), items_of(spark, sf_dir), ladder)

    @cached_property
    def ratings(self) -> DataFrame:
        return self.ws.table(self.source, "ratings")

    def _split(self, df: DataFrame, step: int, add_back: bool) -> Split:
        return split_and_repair(
            self.ws, df, quartile_stratum(self.ws, df, "rating"), self.fractions[step], [self.row_key],
            self.seeds[step], KNOWN_KEYS, add_back, QUARTILE_STRATA,
        )

    @cached_property
    def outer(self) -> Split:
        """All ratings into those to work with and the final hold-out."""
        return self._split(self.ratings, 0, add_back=True)

    @cached_property
    def inner(self) -> Split:
        """The ratings to work with into train and test."""
        return self._split(self.outer.train, 1, add_back=False)

    @cached_property
    def features(self) -> Kept:
        """Features per item."""
        return self.ladder.features(self.ws, self.items)

    @property
    def model(self) -> LadderModel:
        """All effects, fitted on train."""
        return self.fit(tuple(MODELS))

    def fit(self, models: Sequence[str]) -> LadderModel:
        """The effects that ``models`` need, fitted on train; earlier fits are extended, not repeated."""
        self._fitted = self.ladder.fit(self.ws, self.inner.train, self.features, models, self._fitted)
        return self._fitted

    def compare(self, models: Sequence[str] = COMPARED, na: str = "propagate") -> DataFrame:
        """RMSE of the models on test."""
        return self.fit(models).evaluate(self.ws, self.inner.holdout, self.features, models, na)

    def refit(self, model: str = "8") -> LadderModel:
        """The chosen model fitted again on everything but the final hold-out."""
        self._refitted = self.ladder.fit(self.ws, self.outer.train, self.features, [model], self._refitted)
        return self._refitted

    def final_score(self, model: str = "8") -> DataFrame:
        """RMSE of the refitted model on the final hold-out."""
        return self.refit(model).evaluate(self.ws, self.outer.holdout, self.features, [model])

    def final_predictions(self, model: str = "8") -> DataFrame:
        """The final hold-out with the predictions of the refitted model."""
        return self.refit(model).transform(self.ws, self.outer.holdout, self.features, model)

    def split_counts(self) -> DataFrame:
        """Number of ratings on every side of both splits."""
        parts = {
            "rows": self.ratings,
            "drawn": self.outer.drawn,
            "validation": self.outer.holdout,
            "given_back": self.outer.removed,
            "work": self.outer.train,
            "train": self.inner.train,
            "test_drawn": self.inner.drawn,
            "test": self.inner.holdout,
        }
        counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
                  for name, df in parts.items()]
        result = counts[0]
        for count in counts[1:]:
            result = result.unionByName(count)
        return result

    def joined(self, ratings: DataFrame) -> DataFrame:
        return joined(self.ws, ratings, self.items)
