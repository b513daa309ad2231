"""Feature columns. All but the rating year depend on the item only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starrung.functions import (
    age_group,
    label_count,
    label_profile,
    rating_year,
    release_year,
    sequel_flag,
)
from starrung.operators.joins import lookup
from starrung.workspace import Workspace


def item_features(
    items: DataFrame, vocabulary: Sequence[str], as_of_year: int, match: str = "substring"
) -> DataFrame:
    """``item_id, profile, num_genre, release_year, age_group, sequel``, computed once per item."""
    genres, title = F.col("genres"), F.col("title")
    return items.select(
        "item_id",
        label_profile(genres, vocabulary, match).alias("profile"),
        label_count(genres).alias("num_genre"),
        release_year(title).alias("release_year"),
        age_group(release_year(title), as_of_year).alias("age_group"),
        sequel_flag(title).alias("sequel"),
    )


def rating_features(
    ws: Workspace, ratings: DataFrame, items: DataFrame, vocabulary: Sequence[str], as_of_year: int
) -> DataFrame:
    """Ratings widened by the features of their item and by the rating year."""
    per_item = item_features(items, vocabulary, as_of_year).drop("profile")
    return lookup(ratings, per_item, ["item_id"], ws=ws).withColumn("year_stamp", rating_year(F.col("ts")))
