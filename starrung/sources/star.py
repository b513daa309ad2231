"""A ratings and items view over the star-schema tables ``lineitem orders part``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starrung.operators.joins import lookup
from starrung.workspace import Workspace

# The label vocabulary of the items view.
VIEW_LABELS = (
    "ECONOMY",
    "LARGE",
    "MEDIUM",
    "PROMO",
    "SMALL",
    "STANDARD",
    "anvil",
    "blue",
    "bolt",
    "cold",
    "gear",
    "gizmo",
    "hot",
    "large",
    "new",
    "old",
    "plate",
    "red",
    "ring",
    "rod",
    "small",
    "widget",
    "(no genres listed)",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(df: DataFrame, name: str) -> Column:
    """Epoch seconds of a timestamp of either kind, independent of the session time zone."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(name))
    return F.unix_seconds(F.col(name).cast("timestamp"))


def ratings_of(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """``user_id, item_id, rating, ts, row_key`` of all lines; with ``sparse`` every order is a user with few ratings.

    Ratings of one part in 97 have an id that no item has. Orders have one row
    per key; an order with very many lines is left to the skewed-join handling
    of adaptive execution, which splits the lines' side.
    """
    lines = _table(spark, sf_dir, "lineitem")
    lines = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        _epoch(lines, "l_shipdate").alias("ts"),
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    year = F.year(F.date_from_unix_date(F.floor(F.col("ts") / 86400).cast("int")))
    steps = (
        F.ceil(F.col("l_quantity") / 10)
        + (F.col("l_partkey") % 7 - 3)
        + (F.col("o_custkey") % 5 - 2)
        + (year % 3 - 1)
        + 2
    )
    stars = F.least(F.lit(10), F.greatest(F.lit(1), steps)).cast("double") / 2
    row_key = F.concat_ws(
        ":",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_quantity").cast("bigint").cast("string"),
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey" if sparse else "o_custkey").alias("user_id"),
        F.when(F.col("l_partkey") % 97 == 0, -1 - F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("item_id"),
        stars.alias("rating"),
        "ts",
        row_key.alias("row_key"),
    )


def items_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, title, genres``."""
    key = F.col("p_partkey")
    word = F.split(F.col("p_name"), " ")

    def nth(i: int) -> Column:
        return F.coalesce(F.get(word, F.lit(i)), F.lit(""))

    title = F.concat(
        F.col("p_name"),
        F.when(key % 6 == 0, F.concat(F.lit(": "), F.col("p_type"))).otherwise(""),
        F.when(key % 50 == 7, "").otherwise(
            F.concat(F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")"))
        ),
    )
    genres = F.when(key % 41 == 0, "(no genres listed)").otherwise(
        F.concat_ws("|", F.col("p_type"), F.when(key % 2 == 0, nth(0)), F.when(key % 3 == 0, nth(1)))
    )
    return (
        _table(spark, sf_dir, "part")
        .select(key.alias("item_id"), title.alias("title"), genres.alias("genres"))
    )


def joined(ws: Workspace, ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Every rating with the title and labels of its item, NULL where the item is not listed."""
    return lookup(ratings, items, ["item_id"], ws=ws)
