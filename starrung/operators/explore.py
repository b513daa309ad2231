"""Counts, frequencies, ranges, vocabularies, previews and the sparse matrix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starrung.functions.labels import split_labels
from starrung.functions.measures import decimals_of, max_of, min_of
from starrung.operators.joins import semi_join
from starrung.operators.split import hash_order, sample_keys
from starrung.workspace import Workspace


# Columns of a wide matrix; a plan with many more takes long to compile.
WIDEST = 5000


def count_per_key(df: DataFrame, key: str, name: str = "num_ratings") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def distinct_counts(df: DataFrame, **names: str) -> DataFrame:
    """Number of distinct values per column, NULL counted as one value; ``name=column``.

    Each column has its own grouping, pre-aggregated before the shuffle.
    """
    groups = [df.select(F.col(c).alias("value")).distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
              for name, c in names.items()]
    return reduce(DataFrame.unionByName, groups).agg(
        *[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])


def frequencies(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Rows per non-NULL value in value order."""
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(count.alias("count")).orderBy(value)


def value_range(df: DataFrame, value: str, na: str = "propagate") -> DataFrame:
    column = F.col(value)
    return df.agg(min_of(column, na).alias("lowest"), max_of(column, na).alias("highest"))


def label_vocabulary(df: DataFrame, labels: str) -> DataFrame:
    """All single labels that occur. Equal label strings collapse before they are taken apart."""
    return df.select(labels).distinct().select(F.explode(split_labels(F.col(labels))).alias("label")).distinct()


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 6) -> DataFrame:
    """The first ``n`` rows in a stated order, since a distributed table has none of its own."""
    return df.orderBy(*order).limit(n)


def members(ws: Workspace, df: DataFrame, **allowed: DataFrame) -> DataFrame:
    """Rows whose columns all take values from the given one-column tables; ``column=table``."""
    for column, table in allowed.items():
        df = semi_join(ws, df, table.toDF(column), column)
    return df


def sparse_matrix(df: DataFrame, row: str, column: str, value: str, columns: Sequence) -> DataFrame:
    """One row per ``row``, one column per listed value of ``column``, NULL where there is no entry.

    Several entries for a cell are resolved to their maximum.
    """
    return df.select(row, column, value).groupBy(row).pivot(column, list(columns)).agg(F.max(value))


def sparse_sample(
    ws: Workspace, df: DataFrame, row: str, column: str, value: str, rows: int, columns: int, seed: int
) -> DataFrame:
    """A corner of the matrix: ``rows`` random row keys and the first ``columns`` columns of theirs.

    Columns are named ``pick_1``, ``pick_2``, ... in the random order.
    """
    matrix = wide_matrix(ws, df, row, column, value, rows, seed)
    return matrix.select(*matrix.columns[: columns + 1])


def wide_matrix(
    ws: Workspace, df: DataFrame, row: str, column: str, value: str, rows: int, seed: int, most: int = WIDEST
) -> DataFrame:
    """The matrix of ``rows`` random row keys with all their columns, ``pick_1``, ``pick_2``, ... in a random order.

    More than ``most`` columns are an error; such a matrix is better left as rows.
    """
    chosen = members(ws, df.select(row, column, value), **{row: sample_keys(df, row, rows, seed)})
    chosen = ws.table(chosen, "sparse-rows")
    picks = chosen.select(column).distinct().orderBy(hash_order(seed, column)).limit(most + 1)
    values = [r[0] for r in picks.collect()]
    if len(values) > most:
        raise ValueError(f"the rows have more than {most} columns")
    matrix = sparse_matrix(chosen, row, column, value, values)
    return matrix.toDF(row, *[f"pick_{i}" for i in range(1, len(values) + 1)])


def displayed(ws: Workspace, df: DataFrame, digits: int = 6) -> DataFrame:
    """A short result table with its floating-point columns as text, as a printed table shows them.

    A column has one number of decimals: as many as its values need to show ``digits`` significant digits each,
    without zeros that all of them end in. NULL stays NULL, NaN and infinite values are named.
    """
    table = ws.few(df, "displayed").df
    numbers = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not numbers:
        return table
    most = table.agg(*[F.max(decimals_of(F.col(f"`{c}`"), digits)).alias(c) for c in numbers]).first().asDict()
    # format_string would write NULL as a word.
    return table.withColumns({c: F.when(F.col(f"`{c}`").isNotNull(), F.format_string(f"%.{most[c] or 0}f", F.col(f"`{c}`")))
                              for c in numbers})
