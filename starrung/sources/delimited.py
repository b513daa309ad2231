"""Readers for headerless text whose fields are separated by ``::``."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "::"

RATING_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

ITEM_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings file: user, item, rating, epoch seconds. Splittable, typed while parsing."""
    return spark.read.csv(path, sep=SEPARATOR, quote="", schema=RATING_SCHEMA)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items file: id, title, labels.

    Lines are cut into three pieces at most, so a further separator stays in
    the labels; missing pieces are empty strings, quotes have no meaning.
    """
    fields = F.split(F.col("value"), SEPARATOR, 3)

    def piece(i: int):
        return F.coalesce(F.get(fields, F.lit(i)), F.lit(""))

    return spark.read.text(path).select(
        piece(0).try_cast("bigint").alias("item_id"),
        piece(1).alias("title"),
        piece(2).alias("genres"),
    )


def malformed_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a ratings file, as ``value``, that are not four fields with numbers in them.

    ``read_ratings`` reads such lines with NULL for what is no number, and leaves surplus fields out.
    """
    fields = F.split(F.col("value"), SEPARATOR, -1)
    kinds = [field.dataType.simpleString() for field in RATING_SCHEMA]
    numbers = [F.get(fields, F.lit(i)).try_cast(kind).isNotNull() for i, kind in enumerate(kinds)]
    return spark.read.text(path).where(~((F.size(fields) == len(kinds)) & reduce(and_, numbers)))


def describe_schema(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Position, name and type of every column, with the number of rows of the table.

    ``rows`` is a table with as many rows that is cheaper to count.
    """
    columns = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), F.lit(kind).alias("type"))
        for i, (name, kind) in enumerate(df.dtypes, start=1)
    ]
    counted = (df if rows is None else rows).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("rows", F.inline(F.array(*columns))).select("position", "name", "type", "rows")
