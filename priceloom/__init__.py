"""Tabular price regression on Spark: plan columns, clean, derive, encode,
split, boost, score and report, all as DataFrame expressions and Spark ML."""

__version__ = "0.1.0"
