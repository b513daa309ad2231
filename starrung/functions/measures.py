"""Aggregates that can let a missing value through instead of skipping it, and numbers as they are displayed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_na(na: str) -> None:
    if na not in ("propagate", "skip"):
        raise ValueError(f"na must be 'propagate' or 'skip', not {na!r}")


def all_present(value: Column, aggregate: Column, na: str) -> Column:
    """``aggregate``, or NULL in ``propagate`` mode when any ``value`` is NULL."""
    check_na(na)
    if na == "skip":
        return aggregate
    return F.when(F.count(value) == F.count(F.lit(1)), aggregate)


def mean_of(value: Column, na: str = "propagate") -> Column:
    return all_present(value, F.avg(value), na)


def min_of(value: Column, na: str = "propagate") -> Column:
    return all_present(value, F.min(value), na)


def max_of(value: Column, na: str = "propagate") -> Column:
    return all_present(value, F.max(value), na)


def rmse(actual: Column, predicted: Column, na: str = "propagate") -> Column:
    """Root mean squared error; ``predicted`` may be a column or a literal."""
    error = actual - predicted
    return all_present(error, F.sqrt(F.avg(error * error)), na)


def decimals_of(value: Column, digits: int) -> Column:
    """Decimals that show a number with ``digits`` significant digits, without zeros at the end; 0 for NULL and NaN."""
    size = F.abs(value)
    # Rounded by the format, so that 9.999996 counts as 10.
    shown = F.format_string(f"%.{digits - 1}e", size)
    mantissa = F.length(F.rtrim(F.translate(F.substring_index(shown, "e", 1), ".", ""), F.lit("0")))
    power = F.substring_index(shown, "e", -1).cast("int")
    finite = (size > 0) & (size < F.lit(float("inf"))) & ~F.isnan(size)
    return F.when(finite, F.greatest(F.lit(0), mantissa - 1 - power)).otherwise(0)
