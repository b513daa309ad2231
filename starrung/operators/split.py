"""Exact stratified splits, hold-out repair and key samples.

Rows are ordered by the md5 of a seed and a row key. A stratum's share is found
by counting hash prefixes, which Spark pre-aggregates before the shuffle. One
more reading then writes both sides; only the few rows that share the cut-off
prefix are looked at one by one. Where the number of strata is bounded, both
readings are one query, and so are finding and using the cut-off hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from starrung.operators.binning import assign_bins, quantile_breaks
from starrung.operators.copies import expand_copies
from starrung.operators.joins import heavy_keys, is_small, lookup
from starrung.operators.ordering import with_running_total
from starrung.workspace import Kept, Workspace

# Hex digits of the first count: 4096 groups per stratum.
FIRST_DIGITS = 3
MORE_DIGITS = 4
_REST, _HELD, _NEAR = 0, 1, 2
# Hashes of one stratum that one task may rank.
RANKED_HASHES = 200_000
# Strata whose cut-offs are broadcast without measuring them, and the bytes one of them takes at most.
STATED_STRATA, STRATUM_BYTES = 1024, 256
# Four quartiles and NULL.
QUARTILE_STRATA = 5


def hash_order(seed: int, *key: str) -> Column:
    """Pseudo-random but reproducible order of rows."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def quartile_stratum(ws: Workspace, df: DataFrame, column: str) -> Column:
    """Stratum number of a numeric column: its quartile, with equal quartiles merged; ``QUARTILE_STRATA`` at most."""
    breaks = quantile_breaks(ws, df.select(column), F.col(column), 4, dedupe=True)
    return assign_bins(F.col(column), breaks)


def stratified_split(
    ws: Workspace,
    df: DataFrame,
    stratum: Column,
    fraction: float,
    key: Sequence[str],
    seed: int,
    ranked_hashes: int = RANKED_HASHES,
    strata: int | None = None,
) -> DataFrame:
    """``df`` with ``held_out``: true for exactly ``ceil(n * fraction)`` rows of every stratum.

    The result is written, both sides apart, so that a filter on ``held_out``
    reads one side only. ``strata`` is a bound of the number of strata of a
    numeric column, NULL included, if one is known; it saves a step.
    """
    columns = df.columns
    rows = df.withColumns({"__stratum": stratum, "__hash": hash_order(seed, *key)})
    prefix = F.substring("__hash", 1, FIRST_DIGITS)
    picked = _first_bucket(rows.groupBy("__stratum", prefix.alias("__prefix")), fraction)
    if strata is not None and strata <= STATED_STRATA:
        bucket = Kept(picked, strata, strata * STRATUM_BYTES, frozenset(["__stratum"]))
    else:
        bucket = ws.keep(picked, "bucket")
    side = (
        F.when(F.col("__prefix").isNull() | (prefix > F.col("__prefix")), _REST)
        .when(prefix < F.col("__prefix"), _HELD)
        .otherwise(_NEAR)
    )
    placed = lookup(rows, bucket, ["__stratum"]).withColumn("__side", side)
    only_near = [F.when(F.col("__side") == _NEAR, F.col(c)).alias(c) for c in ("__stratum", "__need", "__hash")]
    sides, seen = ws.counted(placed.select(*columns, *only_near, "__side"), "sides", ("__side",),
                             near=F.count_if(F.col("__side") == _NEAR))
    clear = sides.where(F.col("__side") != _NEAR).select(*columns, (F.col("__side") == _HELD).alias("held_out"))
    near = sides.where(F.col("__side") == _NEAR)
    return clear.unionByName(_split_near(ws, near, columns, bucket, seen["near"] or 0, ranked_hashes))


def _first_bucket(by_prefix: GroupedData, fraction: float) -> DataFrame:
    """Per stratum the hash prefix at which its share ends, and the rows it takes there."""
    counted = by_prefix.agg(F.count(F.lit(1)).alias("__n"))
    in_stratum = F.sum("__n").over(Window.partitionBy("__stratum"))
    counted = counted.withColumn("__need", F.ceil(in_stratum * F.lit(fraction)))
    return _pick(counted, "__prefix")


def _pick(buckets: DataFrame, bucket: str) -> DataFrame:
    """The bucket in which each stratum reaches ``__need`` rows, and how many it takes there."""
    upto = F.sum("__n").over(Window.partitionBy("__stratum").orderBy(bucket))
    return (
        buckets.withColumn("__upto", upto)
        .where((F.col("__upto") >= F.col("__need")) & (F.col("__upto") - F.col("__n") < F.col("__need")))
        .withColumn("__need", F.col("__need") - F.col("__upto") + F.col("__n"))
        .drop("__upto")
    )


def _split_near(
    ws: Workspace, near: DataFrame, columns: Sequence[str], bucket: Kept, rows: int, ranked_hashes: int
) -> DataFrame:
    """``held_out`` for the ``rows`` rows that share the cut-off prefix of their stratum, written."""
    cut = _cut_offs(ws, near, bucket, rows, ranked_hashes)
    order, limit = F.col("__hash"), F.col("__limit")
    held = F.when(order != limit, order < limit).when(F.col("__take") == F.col("__n"), True)
    flagged = lookup(near, cut, ["__stratum"]).select(*columns, "__stratum", "__take", held.alias("held_out"))
    flagged, seen = ws.counted(flagged, "near-sides", ("held_out",), torn=F.count_if(F.col("held_out").isNull()))
    whole = flagged.where(F.col("held_out").isNotNull()).select(*columns, "held_out")
    if not seen["torn"]:
        return whole
    tied = _divide_ties(ws, flagged.where(F.col("held_out").isNull()).drop("held_out"), columns, seen["torn"])
    return whole.unionByName(ws.table(tied, "tied-sides", ("held_out",)))


def _cut_offs(ws: Workspace, near: DataFrame, bucket: Kept, rows: int, ranked_hashes: int) -> Kept:
    """Per stratum the last hash taken, with the number of rows that have it and that are taken.

    There is at most one row for each row of ``bucket``, so its size is known beforehand.
    """
    # Equal hashes collapse here, so a key with many copies is one row.
    hashes = near.groupBy("__stratum", "__need", "__hash").agg(F.count(F.lit(1)).alias("__n"))
    if rows > ranked_hashes:
        kept = ws.keep(hashes, "hashes")
        digits = FIRST_DIGITS
        while kept.rows > ranked_hashes and _largest_stratum(kept) > ranked_hashes and digits < 32:
            digits = min(32, digits + MORE_DIGITS)
            kept = _narrow(ws, kept.df, digits)
        hashes = kept.df
    found = _pick(hashes, "__hash").select(
        "__stratum", F.col("__hash").alias("__limit"), F.col("__need").alias("__take"), "__n"
    )
    size = bucket.bytes + bucket.rows * STRATUM_BYTES
    cut = Kept(found, bucket.rows, size, frozenset(["__stratum"]))
    return cut if is_small(cut) else ws.keep(found, "cut")


def _largest_stratum(hashes: Kept) -> int:
    return hashes.df.groupBy("__stratum").count().agg(F.max("count")).first()[0]


def _narrow(ws: Workspace, hashes: DataFrame, digits: int) -> Kept:
    """The hashes that share a longer cut-off prefix."""
    prefix = F.substring("__hash", 1, digits)
    counted = hashes.groupBy("__stratum", "__need", prefix.alias("__prefix")).agg(F.sum("__n").alias("__n"))
    bucket = ws.keep(_pick(counted, "__prefix").drop("__n"), "bucket")
    inside = lookup(hashes.drop("__need"), bucket, ["__stratum"], "inner").where(prefix == F.col("__prefix"))
    return ws.keep(inside.drop("__prefix"), "hashes")


def _divide_ties(ws: Workspace, tied: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """The ``rows`` rows that share the last hash, divided in the order of their columns."""
    tied = tied.groupBy("__stratum", "__take", *columns).agg(F.count(F.lit(1)).alias("__copies"))
    placed = ws.table(
        with_running_total(ws, tied, ["__stratum", *columns], "__before", F.col("__copies")), "ties"
    )
    starts = ws.keep(placed.groupBy("__stratum").agg(F.min("__before").alias("__start")), "starts")
    here = F.col("__take") - (F.col("__before") - F.col("__start"))
    divided = lookup(placed, starts, ["__stratum"]).withColumn(
        "__held", F.greatest(F.lit(0), F.least(F.col("__copies"), here))
    )
    held = divided.select(*columns, F.lit(True).alias("held_out"), F.col("__held").alias("__n"))
    rest = divided.select(
        *columns, F.lit(False).alias("held_out"), (F.col("__copies") - F.col("__held")).alias("__n")
    )
    return expand_copies(held.unionByName(rest), "__n", rows)


class Repaired(NamedTuple):
    train: DataFrame
    holdout: DataFrame
    removed: DataFrame


def repair_holdout(
    ws: Workspace, train: DataFrame, holdout: DataFrame, keys: Sequence[str], add_back: bool
) -> Repaired:
    """Keep hold-out rows all of whose ``keys`` occur in ``train``.

    The other rows return to ``train`` with ``add_back`` and vanish otherwise.
    Only keys missing from ``train`` are looked up: a key with many rows is
    hardly ever among them, so that table is short.
    """
    unknown = _unknown(ws, train, holdout, keys)
    if not unknown:
        return Repaired(train, holdout, holdout.limit(0))
    checked = holdout
    for key, table in unknown.items():
        # The counts tell which of the unknown keys are heavy; beyond the bound each level is written once.
        checked = lookup(checked, replace(table, df=table.df.drop("__rows")), [key], ws=ws,
                         heavy=lambda key=key, table=table: heavy_keys(table.df, [key], weight=F.col("__rows")))
    marks = [F.col(f"__known_{key}") for key in unknown]
    checked = checked.select(*holdout.columns, F.coalesce(*marks, F.lit(True)).alias("__complete"))
    checked = ws.table(checked, "checked", ("__complete",))
    kept = checked.where("__complete").drop("__complete")
    removed = checked.where("not __complete").drop("__complete")
    return Repaired(train.unionByName(removed) if add_back else train, kept, removed)


def _unknown(ws: Workspace, train: DataFrame, holdout: DataFrame, keys: Sequence[str]) -> dict[str, Kept]:
    """The keys of ``holdout`` that ``train`` lacks, with their rows, for each key column that has some.

    All key columns go through one grouping, each row once for each of them.
    """
    def spread(df: DataFrame, known: bool) -> list[DataFrame]:
        return [
            df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows")).select(
                F.lit(key).alias("__which"), F.lit(known).alias("__known"), "__rows",
                *[F.col(k) if k == key else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys])
            for key in keys
        ]

    every = reduce(DataFrame.unionByName, spread(holdout, False) + spread(train, True))
    absent = every.groupBy("__which", *keys).agg(F.max("__known").alias("__known"), F.sum("__rows").alias("__rows"))
    kept = ws.keep(absent.where(~F.col("__known")), "unknown", **{
        f"__{what}_{key}": F.count_if((F.col("__which") == key) & condition)
        for key in keys for what, condition in (("of", F.lit(True)), ("null", F.col(key).isNull()))})
    found = {}
    for key in keys:
        if kept.totals[f"__of_{key}"]:
            df = kept.df.where(F.col("__which") == key).select(key, F.col("__known").alias(f"__known_{key}"), "__rows")
            nulls = frozenset([key] if kept.totals[f"__null_{key}"] else [])
            found[key] = Kept(df, kept.totals[f"__of_{key}"], kept.bytes, nulls)
    return found


class Split(NamedTuple):
    drawn: DataFrame
    train: DataFrame
    holdout: DataFrame
    removed: DataFrame


def split_and_repair(
    ws: Workspace,
    df: DataFrame,
    stratum: Column,
    fraction: float,
    key: Sequence[str],
    seed: int,
    keys: Sequence[str],
    add_back: bool,
    strata: int | None = None,
) -> Split:
    """Draw a stratified hold-out and repair it; ``strata`` bounds the number of strata, if that is known."""
    sides = stratified_split(ws, df, stratum, fraction, key, seed, strata=strata)
    drawn = sides.where("held_out").drop("held_out")
    rest = sides.where("not held_out").drop("held_out")
    return Split(drawn, *repair_holdout(ws, rest, drawn, keys, add_back))


def sample_keys(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """``k`` distinct keys; every key is equally likely whatever its number of rows."""
    return df.select(key).distinct().orderBy(hash_order(seed, key)).limit(k)


def shuffle_keys(ws: Workspace, df: DataFrame, key: str, seed: int) -> DataFrame:
    """All distinct keys with their ``position`` (from 1) in a random order."""
    shuffled = df.select(key).distinct().withColumn("__hash", hash_order(seed, key))
    placed = with_running_total(ws, shuffled, ["__hash", key], "position")
    return placed.select(key, (F.col("position") + 1).alias("position"))

