"""Cleaning: log target, null fill, outlier filter, invalid rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions import is_number, log_target, zero_if_null
from priceloom.operators.schema import LOG_TARGET, ColumnPlan

# Fixed value: half-width of the outlier filter in standard deviations.
SIGMAS = 3.0


def with_log_target(df: DataFrame, target: str) -> DataFrame:
    """Add (or overwrite) ``log_price`` = ln(1 + target)."""
    return df.withColumn(LOG_TARGET, log_target(target))


def booleans_as_numbers(df: DataFrame, plan: ColumnPlan) -> DataFrame:
    if not plan.boolean:
        return df
    return df.withColumns({c: F.col(c).cast("int") for c in plan.boolean})


def fill_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null -> 0 in every named column, types kept, in one projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: zero_if_null(c, types[c]) for c in columns})


def drop_unlabelled(df: DataFrame, column: str = LOG_TARGET) -> DataFrame:
    """Drop rows whose label is null, NaN or infinite; no model can be fitted
    on them, and one would spoil every statistic."""
    return df.filter(is_number(column))


def drop_invalid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop(subset=list(columns))


def target_stats(df: DataFrame, column: str = LOG_TARGET) -> DataFrame:
    """One row: (n, mean, stddev) with the sample standard deviation."""
    return drop_unlabelled(df, column).agg(
        F.count("*").alias("n"),
        F.mean(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
    )


def sigma_bounds(df: DataFrame, column: str = LOG_TARGET, sigmas: float = SIGMAS) -> DataFrame:
    """One row: (lower, upper), both null for fewer than two labels."""
    width = F.lit(sigmas) * F.col("stddev")
    return target_stats(df, column).select(
        (F.col("mean") - width).alias("lower"),
        (F.col("mean") + width).alias("upper"),
    )


def inside(column: str, lower: Column, upper: Column) -> Column:
    """lower <= column <= upper; a null or NaN bound does not restrict."""
    value = F.col(column)
    above = F.coalesce(value >= lower, F.lit(True)) | F.isnan(lower)
    below = F.coalesce(value <= upper, F.lit(True)) | F.isnan(upper)
    return is_number(column) & F.coalesce(above, F.lit(True)) & F.coalesce(below, F.lit(True))


def lazy_bounds(df: DataFrame, column: str = LOG_TARGET, sigmas: float = SIGMAS) -> tuple[Column, Column]:
    """The bounds as two scalar subqueries over ``df``. Spark merges the two
    into one aggregate, runs it before the main scan and puts the values into
    the filter: no join and no driver round trip in the plan."""
    bounds = sigma_bounds(df, column, sigmas)
    return bounds.select("lower").scalar(), bounds.select("upper").scalar()


def keep_within_sigma(
    df: DataFrame,
    column: str = LOG_TARGET,
    sigmas: float = SIGMAS,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Keep rows within ``sigmas`` standard deviations of the mean, bounds
    included. ``fit_on`` names the rows the statistics come from: all of ``df``
    by default, or the training rows to keep test labels out of the bounds."""
    lower, upper = lazy_bounds(df if fit_on is None else fit_on, column, sigmas)
    return df.filter(inside(column, lower, upper))


def outlier_counts(df: DataFrame, column: str = LOG_TARGET, sigmas: float = SIGMAS) -> DataFrame:
    """One row: rows before the filter, kept, removed, and without a label."""
    lower, upper = lazy_bounds(df, column, sigmas)
    total, kept = F.count("*"), F.count_if(inside(column, lower, upper))
    return df.agg(
        total.alias("n_rows"),
        kept.alias("n_kept"),
        (total - kept).alias("n_removed"),
        F.count_if(~is_number(column)).alias("n_unlabelled"),
    )
