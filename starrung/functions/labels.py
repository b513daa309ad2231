"""Columns derived from a multi-valued label string such as ``Comedy|Drama``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label vocabulary of the movie data set.
MOVIE_LABELS = (
    "Comedy",
    "Romance",
    "Action",
    "Crime",
    "Thriller",
    "Drama",
    "Sci-Fi",
    "Adventure",
    "Children",
    "Fantasy",
    "War",
    "Animation",
    "Musical",
    "Western",
    "Mystery",
    "Film-Noir",
    "Horror",
    "Documentary",
    "IMAX",
    "(no genres listed)",
)

_SEPARATOR = r"\|"


def flag_name(label: str, prefix: str = "is_") -> str:
    """Column name for a label: ``Sci-Fi`` becomes ``is_scifi``; case is kept apart where given."""
    return prefix + re.sub(r"[^0-9A-Za-z]+", "", label).lower()


def flag_names(labels: Sequence[str], prefix: str = "is_") -> list[str]:
    """Distinct names for all labels; labels that differ only in case get a ``_2`` suffix."""
    names: list[str] = []
    for label in labels:
        name = flag_name(label, prefix)
        repeat = sum(flag_name(earlier, prefix) == name for earlier in labels[: len(names)])
        names.append(f"{name}_{repeat + 1}" if repeat else name)
    return names


def split_labels(labels: Column) -> Column:
    """Array of single labels."""
    return F.split(labels, _SEPARATOR)


def label_flag(labels: Column, label: str, match: str = "substring") -> Column:
    """1 or 0 for a label, NULL for a NULL label string.

    ``substring`` is case-sensitive containment, so ``old`` is found in
    ``cold``; ``token`` compares whole labels; ``regex`` takes the label as a
    pattern, in which parentheses only group.
    """
    if match == "regex":
        return F.rlike(labels, F.lit(label)).cast("int")
    if match == "substring":
        return F.contains(labels, F.lit(label)).cast("int")
    if match == "token":
        return F.array_contains(split_labels(labels), label).cast("int")
    raise ValueError(f"match must be 'substring', 'token' or 'regex', not {match!r}")


def label_flags(labels: Column, vocabulary: Sequence[str], match: str = "substring") -> list[Column]:
    """One flag column per label, named ``is_<label>``."""
    names = flag_names(vocabulary)
    return [label_flag(labels, label, match).alias(name) for label, name in zip(vocabulary, names)]


def label_profile(labels: Column, vocabulary: Sequence[str], match: str = "substring") -> Column:
    """All flags as one string of 0 and 1: a compact grouping key for a label combination."""
    return F.concat(*[label_flag(labels, label, match).cast("string") for label in vocabulary])


def label_count(labels: Column) -> Column:
    """Number of labels in the string."""
    return F.regexp_count(labels, F.lit(_SEPARATOR)) + F.lit(1)
