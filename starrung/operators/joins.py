"""Key lookups that stay balanced when one key holds a large share of the rows.

A lookup side is broadcast only after its size was measured. Beyond the bound
the join shuffles, and the heaviest keys are taken out first: there are at most
``heavy_limit`` of them, so their side can always be broadcast and their rows
are never moved. Both parts together are the whole result.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starrung.workspace import Kept, Workspace, measured

BROADCAST_BYTES = 64 << 20
HEAVY_ROWS = 1_000_000


def is_small(table: Kept) -> bool:
    """Whether the measured size of ``table`` allows a broadcast."""
    return table.bytes <= BROADCAST_BYTES


def heavy_limit(df: DataFrame) -> int:
    """Number of keys worth treating apart; any other key holds less than a fair partition's rows."""
    return max(1024, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def heavy_keys(rows: DataFrame, keys: Sequence[str], weight: Column | None = None) -> list[Row]:
    """The most frequent keys, ``heavy_limit`` at most.

    ``weight`` is given when ``rows`` already has one row per key with its count.
    """
    counted = (
        rows.select(*keys, weight.alias("__n")) if weight is not None
        else rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    )
    top = counted.where(F.col("__n") >= HEAVY_ROWS).orderBy(F.desc("__n")).limit(heavy_limit(rows))
    return top.select(*keys).collect()


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, nulls: Collection[str] | None = None
) -> DataFrame:
    """Equi-join on shared column names where NULL matches NULL; keys appear once.

    ``nulls`` names the columns in which ``right`` may have NULLs. For the other
    keys plain equality gives the same rows and a leaner hash table.
    """
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})

    def equal(key: str) -> Column:
        other = renamed[f"__{key}"]
        return left[key].eqNullSafe(other) if nulls is None or key in nulls else left[key] == other

    return left.join(renamed, reduce(and_, map(equal, keys)), how).drop(*[f"__{k}" for k in keys])


def lookup(
    rows: DataFrame,
    table: DataFrame | Kept,
    keys: Sequence[str],
    how: str = "left",
    heavy: Callable[[], list[Row]] | None = None,
    balanced: bool = False,
    ws: Workspace | None = None,
) -> DataFrame:
    """Join many ``rows`` to a ``table`` that has one row per key; ``how`` is left, inner, left_semi or left_anti.

    ``heavy`` gives the keys to keep out of the shuffle and is called only if
    there is one; without it they are found by counting. ``balanced`` says that
    no key of ``rows`` is frequent, so that none has to be taken out. Beyond the
    bound ``rows`` is read up to three times; with ``ws`` it is written first.
    """
    if not isinstance(table, Kept):
        table = measured(table)
    if is_small(table):
        return null_safe_join(rows, F.broadcast(table.df), keys, how, table.nulls)
    if balanced:
        return null_safe_join(rows, table.df, keys, how, table.nulls)
    if ws is not None:
        rows = ws.table(rows, "rows")
    found = heavy() if heavy else heavy_keys(rows, keys)
    if not found:
        return null_safe_join(rows, table.df, keys, how, table.nulls)
    heavy_table = F.broadcast(rows.sparkSession.createDataFrame(found, rows.select(*keys).schema))
    # The same join type on the short key list says what becomes of each heavy row.
    outcome = null_safe_join(heavy_table, null_safe_join(table.df, heavy_table, keys, "left_semi"), keys, how)
    stay = null_safe_join(rows, F.broadcast(outcome), keys, "inner")
    move = null_safe_join(rows, heavy_table, keys, "left_anti")
    return stay.unionByName(null_safe_join(move, table.df, keys, how, table.nulls))


def semi_join(ws: Workspace, rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs in ``other``; NULL counts as a value."""
    return lookup(rows, ws.keep(other.select(key).distinct(), f"keys-{key}"), [key], "left_semi", ws=ws)


def natural_anti_join(ws: Workspace, left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that equal no row of ``right`` in all shared columns, copies kept.

    The distinct rows of ``right`` are looked up, so ``left`` is only moved if they are too many to broadcast.
    """
    shared = [c for c in left.columns if c in right.columns]
    return lookup(left, ws.keep(right.select(*shared).distinct(), "shared"), shared, "left_anti", ws=ws)
