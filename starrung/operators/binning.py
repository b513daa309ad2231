"""Quantile breaks, equal-count bins and histograms."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from functools import partial, reduce
from itertools import accumulate
from math import ceil, log2
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starrung.operators.ordering import with_running_total
from starrung.workspace import Kept, Workspace

# Up to this many distinct values one task adds up their counts; the result is the same either way.
SINGLE_TASK_VALUES = 1_000_000
# Up to this many come to the driver instead.
FEW_VALUES = 1000


def value_counts(ws: Workspace, df: DataFrame, value: Column, weight: Column | None = None) -> Kept:
    """Distinct non-NULL values as doubles with the number of rows that have them."""
    return ws.keep(_counted(df, value, weight), "values")


def _counted(df: DataFrame, value: Column, weight: Column | None) -> DataFrame:
    weight = F.lit(1).cast("bigint") if weight is None else weight
    return (
        df.select(value.cast("double").alias("value"), weight.cast("bigint").alias("w"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.sum("w").alias("n"))
    )


def quantile_breaks(
    ws: Workspace,
    df: DataFrame,
    value: Column,
    parts: int,
    weight: Column | None = None,
    dedupe: bool = False,
    rows: int | None = None,
    repeats: bool = False,
) -> list[float]:
    """The ``parts + 1`` exact quantiles at 0, 1/parts, ..., 1, linearly interpolated.

    ``weight`` is the number of rows each row stands for; ``rows`` is the number
    of rows of ``df`` if it is known. Positions are computed in whole numbers.
    Equal breaks raise an error; with ``dedupe`` they are merged, and with
    ``repeats`` they stay, so that bins keep their numbers and some are empty.
    """
    breaks = None
    if rows is not None and rows <= SINGLE_TASK_VALUES:
        breaks = _breaks_in_one_task(_counted(df, value, weight), parts)
    elif SINGLE_TASK_VALUES:
        breaks = _breaks_of_few(_counted(df, value, weight), parts)
    if breaks is None:
        kept = value_counts(ws, df, value, weight)
        rank = _breaks_in_one_task if kept.rows <= SINGLE_TASK_VALUES else partial(_breaks_by_rank, ws)
        breaks = rank(kept.df, parts)
    distinct = sorted(set(breaks))
    if len(distinct) == len(breaks) or dedupe:
        return distinct
    if repeats:
        return breaks
    raise ValueError(f"{len(breaks) - len(distinct)} of {len(breaks)} breaks repeat; too few distinct values")


def _breaks_of_few(counts: DataFrame, parts: int) -> list[float] | None:
    """Quantiles of up to ``FEW_VALUES`` distinct values, which are fetched; None if there are more."""
    got = counts.limit(FEW_VALUES + 1).collect()
    if len(got) > FEW_VALUES:
        return None
    got.sort(key=lambda r: r.value)
    upto = list(accumulate(r.n for r in got))
    if not upto:
        raise ValueError("no values to take quantiles of")
    out = []
    for i in range(parts + 1):
        rank, rest = divmod((upto[-1] - 1) * i, parts)
        low, high = (got[bisect_right(upto, r)].value for r in (rank, min(rank + 1, upto[-1] - 1)))
        out.append(_between(low, high, rest, parts))
    return out


def _breaks_by_rank(ws: Workspace, counts: DataFrame, parts: int) -> list[float]:
    """Quantiles of any number of distinct values, by running totals over ranges of them."""
    rows = counts.agg(F.sum("n")).first()[0]
    if not rows:
        raise ValueError("no values to take quantiles of")
    spots = [divmod((rows - 1) * i, parts) for i in range(parts + 1)]
    ranks = sorted({r for rank, _ in spots for r in (rank, min(rank + 1, rows - 1))})
    placed = with_running_total(ws, counts, ["value"], weight=F.col("n"))
    covers = [(F.col("before") <= r) & (F.lit(r) < F.col("before") + F.col("n")) for r in ranks]
    found = placed.where(reduce(or_, covers)).select("value", "n", "before").collect()
    at = {r: row.value for r in ranks for row in found if row.before <= r < row.before + row.n}
    return [_between(at[rank], at[min(rank + 1, rows - 1)], rest, parts) for rank, rest in spots]


def _between(low: float, high: float, rest: int, parts: int) -> float:
    return low + (high - low) * (rest / parts)


def _breaks_in_one_task(counts: DataFrame, parts: int) -> list[float]:
    """The same arithmetic in one query: the values at the whole ranks around each position."""
    upto = Window.orderBy("value")
    placed = counts.select("value", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("rows"))

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("value")))

    lows = [value_at(F.expr(f"(rows - 1) * {i} div {parts}")) for i in range(parts + 1)]
    highs = [value_at(F.least(F.expr(f"(rows - 1) * {i} div {parts} + 1"), F.col("rows") - 1)) for i in range(parts + 1)]
    row = placed.agg(F.max("rows").alias("rows"), F.array(*lows).alias("low"), F.array(*highs).alias("high")).first()
    if not row.rows:
        raise ValueError("no values to take quantiles of")
    return [_between(row.low[i], row.high[i], (row.rows - 1) * i % parts, parts) for i in range(parts + 1)]


def assign_bins(value: Column, breaks: Sequence[float]) -> Column:
    """Bin number from 1; bins are closed on the right, the lowest value is in bin 1.

    Values outside the breaks go to the first or last bin, NULL stays NULL.
    """
    above = [(value > F.lit(b)).cast("int") for b in breaks[1:-1]]
    return F.when(value.isNotNull(), reduce(add, above, F.lit(1)))


def histogram(
    ws: Workspace, df: DataFrame, value: Column, bins: int | None = None, weight: Column | None = None
) -> DataFrame:
    """Rows per equal-width bin: ``bin, lower, upper, count``, empty bins included.

    Without ``bins`` their number follows Sturges' rule, ceil(log2(rows) + 1).
    """
    counts = value_counts(ws, df, value, weight).df
    low, high, rows = counts.agg(F.min("value"), F.max("value"), F.sum("n")).first()
    if bins is None:
        bins = ceil(log2(rows or 1) + 1)
    width = ((high - low) / bins or 1.0) if low is not None else 1.0
    low = 0.0 if low is None else low
    index = F.least(F.lit(bins - 1), F.floor((F.col("value") - F.lit(low)) / F.lit(width)))
    filled = counts.groupBy(index.alias("bin")).agg(F.sum("n").alias("count"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    # Both sides have one row per bin.
    return every.join(F.broadcast(filled), "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )
