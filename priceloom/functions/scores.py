"""Regression scores as aggregate columns, so that any number of them over any
number of (label, prediction) pairs is one pass with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _error(label: str, prediction: str) -> Column:
    return F.col(label).cast("double") - F.col(prediction)


def r2(label: str, prediction: str) -> Column:
    """1 - SSE / SST. SST comes from the variance aggregate, which merges
    without the cancellation of sum(y^2) - n * mean^2. Null if SST is 0."""
    error = _error(label, prediction)
    seen = F.when(error.isNotNull(), F.col(label).cast("double"))
    total = F.var_pop(seen) * F.count(seen)
    return F.lit(1.0) - F.try_divide(F.sum(error * error), total)


def rmse(label: str, prediction: str) -> Column:
    error = _error(label, prediction)
    return F.sqrt(F.avg(error * error))


def mae(label: str, prediction: str) -> Column:
    return F.avg(F.abs(_error(label, prediction)))


def adjusted_r2(score: Column, rows: Column, features: Column) -> Column:
    """1 - (1 - R2)(n - 1)/(n - p - 1); null when n <= p + 1."""
    freedom = rows - features - F.lit(1)
    shrunk = F.lit(1.0) - (F.lit(1.0) - score) * (rows - F.lit(1)) / freedom
    return F.when(freedom > 0, shrunk)
