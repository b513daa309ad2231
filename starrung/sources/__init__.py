"""Readers for delimited text and the ratings view of the star-schema tables."""

from starrung.sources.delimited import (
    ITEM_SCHEMA,
    RATING_SCHEMA,
    describe_schema,
    malformed_ratings,
    read_items,
    read_ratings,
)
from starrung.sources.star import items_of, joined, ratings_of

__all__ = [
    "ITEM_SCHEMA",
    "RATING_SCHEMA",
    "describe_schema",
    "items_of",
    "joined",
    "malformed_ratings",
    "ratings_of",
    "read_items",
    "read_ratings",
]
