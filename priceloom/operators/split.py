"""Train/test split and folds.

The default split hashes a row key, so it gives the same rows on every layout
and needs no sort and no shuffle. ``random_split`` is the layout-dependent
alternative."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.functions.hashing import FOLD_DIGITS, SPLIT_DIGITS, hash_bucket

# Share of training rows in percent, number of folds, seed.
TRAIN_PERCENT = 80
FOLDS = 5
SEED = 42

SPLIT = "split"
FOLD = "fold"


def with_split(df: DataFrame, key: Sequence[str], train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Add ``split`` = train or test. Rows with equal keys fall on one side."""
    bucket = hash_bucket(key, 100, SPLIT_DIGITS)
    return df.withColumn(SPLIT, F.when(bucket < train_percent, "train").otherwise("test"))


def with_fold(df: DataFrame, key: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """Add ``fold`` in [0, folds), drawn from other digits than the split, so
    folds stay even within the training rows."""
    return df.withColumn(FOLD, hash_bucket(key, folds, FOLD_DIGITS))


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per side, in one aggregate."""
    return df.groupBy(SPLIT).agg(F.count("*").alias("n_rows"))


def fold_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(FOLD).agg(F.count("*").alias("n_rows"))


def random_split(
    df: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """``randomSplit`` as is: the rows drawn depend on the partitioning."""
    train, test = df.randomSplit([train_percent / 100.0, 1 - train_percent / 100.0], seed=seed)
    return train, test
