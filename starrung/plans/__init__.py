"""Whole analyses: the effect ladder and the study that splits, fits and scores."""
