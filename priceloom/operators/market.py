"""Uses of a scored table: mispriced listings and price levels by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.operators.ranking import top_k


def with_relative_gap(df: DataFrame, target: str, estimate: str) -> DataFrame:
    """Add ``relative_gap`` = (target - estimate) / estimate; null at 0."""
    gap = F.try_divide(F.col(target) - F.col(estimate), F.col(estimate))
    return df.withColumn("relative_gap", gap)


def mispriced(df: DataFrame, target: str, estimate: str, threshold: float = 0.25) -> DataFrame:
    """Listings whose price is off the estimate by more than ``threshold``."""
    verdict = F.when(F.col("relative_gap") > 0, "overvalued").otherwise("undervalued")
    return (
        with_relative_gap(df, target, estimate)
        .filter(F.abs("relative_gap") > threshold)
        .withColumn("verdict", verdict)
    )


def most_mispriced(df: DataFrame, target: str, estimate: str, k: int, *key: str, threshold: float = 0.25) -> DataFrame:
    """The k listings furthest off their estimate, ranked; ties by key."""
    found = mispriced(df, target, estimate, threshold)
    return top_k(found, k, F.desc(F.abs("relative_gap")), *[F.asc(c) for c in key])


def price_by_region(df: DataFrame, target: str, *region: str) -> DataFrame:
    """Listing count, mean and sample standard deviation of the price."""
    return df.groupBy(*region).agg(
        F.count("*").alias("n"),
        F.avg(target).alias("mean_price"),
        F.stddev_samp(target).alias("stddev_price"),
    )
