"""Columns derived from a title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def release_year(title: Column) -> Column:
    """First four-digit number in parentheses as an integer, NULL if there is none."""
    in_parentheses = F.regexp_substr(title, F.lit(r"\([0-9]{4}\)"))
    return F.translate(in_parentheses, "()", "").try_cast("int")


def sequel_flag(title: Column) -> Column:
    """True if the title has a colon; a naive mark of a sequel."""
    return F.contains(title, F.lit(":"))
