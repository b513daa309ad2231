"""Grouped-mean effects of a residual, and label scores built from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.functions.measures import mean_of
from starrung.operators.joins import heavy_keys, lookup
from starrung.workspace import Kept


def global_mean(df: DataFrame, value: str = "rating", na: str = "propagate") -> float | None:
    """Mean of a column as a plain number."""
    return df.agg(mean_of(F.col(value), na)).first()[0]


def fit_effect(df: DataFrame, key: str, residual: Column, name: str, na: str = "propagate") -> DataFrame:
    """Mean residual per key as ``effect_<name>``, with the number of rows ``n``."""
    return df.groupBy(key).agg(
        mean_of(residual, na).alias(f"effect_{name}"), F.count(F.lit(1)).alias("n")
    )


def fit_effect_from_sums(cells: DataFrame, key: str, total: Column, name: str) -> DataFrame:
    """The same effect from pre-aggregated ``cells`` with ``n`` rows and a residual ``total`` each."""
    return cells.groupBy(key).agg(
        (F.sum(total) / F.sum("n")).alias(f"effect_{name}"), F.sum("n").alias("n")
    )


def apply_effect(df: DataFrame, effect: DataFrame | Kept, key: str) -> DataFrame:
    """Add the effect of each row's key; NULL keys match, unseen keys get NULL.

    The row counts of the effect table tell which keys are heavy.
    """
    if not isinstance(effect, Kept):
        return lookup(df, effect.drop("n"), [key])
    return lookup(
        df,
        replace(effect, df=effect.df.drop("n")),
        [key],
        heavy=lambda: heavy_keys(effect.df, [key], weight=F.col("n")),
    )


def label_effects(cells: DataFrame, vocabulary: Sequence[str], total: str = "total") -> DataFrame:
    """Mean residual of the rows with and without each label, all labels in one grouping.

    ``cells`` has a label ``profile``, ``n`` rows and a residual ``total``. The
    result has one row per ``position`` of the label and ``flag`` (1, 0 or NULL).
    """
    spots = F.explode(F.sequence(F.lit(1), F.lit(len(vocabulary)))).alias("position")
    per_profile = cells.groupBy("profile").agg(F.sum("n").alias("n"), F.sum(total).alias(total))
    flags = per_profile.select("profile", "n", total, spots)
    flag = F.substr(F.col("profile"), F.col("position"), F.lit(1)).cast("int")
    label = F.element_at(F.array(*[F.lit(v) for v in vocabulary]), F.col("position"))
    return (
        flags.groupBy("position", flag.alias("flag"))
        .agg((F.sum(total) / F.sum("n")).alias("effect"), F.sum("n").alias("n"))
        .select("position", label.alias("label"), "flag", "effect", "n")
    )


def label_score(profile: str, effects: dict[tuple[int, int | None], float], labels: int) -> Column:
    """Sum of the label effects of a ``profile`` column, always added in label order.

    ``effects`` maps (position, flag) to the effect, three entries per label at
    most. A flag value that was not seen while fitting gives NULL.
    """

    def known(position: int, flag: int | None) -> str:
        effect = effects.get((position, flag))
        if effect is None:
            return "cast(null as double)"
        return f"{effect!r}D" if isfinite(effect) else f"double('{effect}')"

    terms = [
        f"(case substring({profile}, {i}, 1) when '1' then {known(i, 1)} when '0' then {known(i, 0)} "
        f"else {known(i, None)} end)"
        for i in range(1, labels + 1)
    ]
    return F.expr(" + ".join(terms))
