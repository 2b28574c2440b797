"""Scalar building blocks. Every function maps columns to a column, so the
work stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def log_target(name: str) -> Column:
    """ln(1 + x); null for x <= -1 and for null."""
    return F.log1p(_double(name))


def expm1_price(name: str) -> Column:
    """Inverse of :func:`log_target`."""
    return F.expm1(F.col(name))


def is_number(name: str) -> Column:
    """True when the double is finite: neither null nor NaN nor infinite."""
    return F.coalesce(F.abs(_double(name)) < float("inf"), F.lit(False)) & ~F.isnan(name)


def zero_if_null(name: str, dtype: DataType) -> Column:
    """0 of the column's own type for null. NaN is not null and stays NaN."""
    return F.coalesce(F.col(name), F.lit(0).cast(dtype))


def square(name: str) -> Column:
    return _double(name) * _double(name)


def product(left: str, right: str) -> Column:
    """Double product, so large integers cannot overflow."""
    return _double(left) * _double(right)


def ratio_or_zero(numerator: str, denominator: str) -> Column:
    """numerator / denominator where the denominator is above 0, else 0."""
    positive = F.col(denominator) > 0
    return F.when(positive, _double(numerator) / _double(denominator)).otherwise(F.lit(0.0))
