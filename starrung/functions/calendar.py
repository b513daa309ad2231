"""Columns derived from dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86400


def rating_year(epoch_seconds: Column) -> Column:
    """UTC calendar year of an epoch time, whatever the session time zone is."""
    return F.year(F.date_from_unix_date(F.floor(epoch_seconds / F.lit(_DAY)).cast("int")))


def age_group(year: Column, as_of_year: int) -> Column:
    """Age in ``as_of_year`` floored to a multiple of five, also for negative ages."""
    age = F.lit(as_of_year) - year
    return age - F.pmod(age, F.lit(5))
