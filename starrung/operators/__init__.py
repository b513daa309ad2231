"""Operators on DataFrames: lookups, splits, bins, effects and exploration."""
