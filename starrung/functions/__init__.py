"""Column functions: labels, titles, calendar and error measures."""

from starrung.functions.calendar import age_group, rating_year
from starrung.functions.labels import (
    MOVIE_LABELS,
    flag_name,
    label_count,
    label_flag,
    label_flags,
    label_profile,
    split_labels,
)
from starrung.functions.measures import mean_of, rmse
from starrung.functions.titles import release_year, sequel_flag

__all__ = [
    "MOVIE_LABELS",
    "age_group",
    "flag_name",
    "label_count",
    "label_flag",
    "label_flags",
    "label_profile",
    "mean_of",
    "rating_year",
    "release_year",
    "rmse",
    "sequel_flag",
    "split_labels",
]
