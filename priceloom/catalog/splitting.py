"""Train/test split and folds."""

from pyspark.sql import functions as F

from priceloom.catalog.base import FOLD_BUCKET, KEY, KEYS, PROP_CTE, SPLIT_CASE, prop, query
from priceloom.operators import split


@query(f"with {PROP_CTE} select {KEYS}, {SPLIT_CASE} as split from prop")
def hash_split(spark, sf_dir):
    return split.with_split(prop(spark, sf_dir), KEY).select(*KEY, split.SPLIT)


@query(f"with {PROP_CTE} select {SPLIT_CASE} as split, count(*) as n_rows from prop group by 1")
def split_counts(spark, sf_dir):
    return split.split_counts(split.with_split(prop(spark, sf_dir), KEY))


@query(
    f"with {PROP_CTE} select cast({FOLD_BUCKET} as int) as fold, count(*) as n_rows from prop "
    f"where {SPLIT_CASE} = 'train' group by 1"
)
def cv_folds(spark, sf_dir):
    train = split.with_split(prop(spark, sf_dir), KEY).filter(F.col(split.SPLIT) == "train")
    return split.fold_counts(split.with_fold(train, KEY))


@query(f"with {PROP_CTE} select {KEYS}, price from prop")
def random_split(spark, sf_dir):
    """Layout-dependent draw; both sides together are all rows, each once."""
    train, test = split.random_split(prop(spark, sf_dir).select(*KEY, "price"))
    return train.unionByName(test)
