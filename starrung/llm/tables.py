"""What the operators share: reading two columns, folds, and rows that belong to a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starrung.operators import joins
from starrung.workspace import Kept, Workspace

# The characters that separate words, as a class of Java and of RE2.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


_spaces: dict[tuple[str, str], Workspace] = {}


def scratch(spark: SparkSession, name: str) -> Workspace:
    """Room for the tables behind one result. Those of the last result of that name in this session are deleted,
    so that repeated calls take no more space; a result must be read before it is made again."""
    key = spark.sparkContext.applicationId, name
    if key in _spaces:
        _spaces.pop(key).release()
    _spaces[key] = Workspace(spark)
    return _spaces[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def is_small(kept: Kept) -> bool:
    """Whether the measured size allows a broadcast."""
    return joins.is_small(kept)


def sized(kept: Kept) -> DataFrame:
    """The table, marked for broadcast if its measured size allows it."""
    return F.broadcast(kept.df) if is_small(kept) else kept.df


def keyed(rows: DataFrame, keys: Kept, key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose key is in (or, with left_anti, not in) a table of distinct keys."""
    other = sized(keys).select(F.col(key).alias("__key"))
    return rows.join(other, rows[key].eqNullSafe(other["__key"]), how)
