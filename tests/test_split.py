import hashlib

import pytest
from pyspark.sql import functions as F

from priceloom.functions import hash_bucket
from priceloom.operators import split

KEY = ["a", "b"]


@pytest.fixture
def rows(spark):
    return spark.range(5000).selectExpr("id as a", "cast(id % 7 as string) as b", "rand(1) as x")


def test_same_split_on_every_layout(rows):
    def sides(df):
        return {(r["a"], r["split"]) for r in split.with_split(df, KEY).collect()}

    assert sides(rows.repartition(1)) == sides(rows.repartition(3)) == sides(rows.repartition(8, "b"))


def test_sides_are_disjoint_and_complete(rows):
    counts = {r["split"]: r["n_rows"] for r in split.split_counts(split.with_split(rows, KEY)).collect()}
    assert sum(counts.values()) == 5000
    assert abs(counts["train"] / 5000 - 0.8) < 0.03


def test_equal_keys_never_cross_sides(rows):
    doubled = split.with_split(rows.union(rows), KEY)
    assert doubled.groupBy(*KEY).agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_bucket_formula(spark):
    df = spark.createDataFrame([(12, "x"), (None, "y")], "a int, b string")
    got = [r[0] for r in df.select(hash_bucket(KEY, 100)).collect()]
    want = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 100 for t in ("12|x", "\\N|y")]
    assert got == want


def test_folds_are_even_within_training_rows(rows):
    train = split.with_split(rows, KEY).filter("split = 'train'")
    counts = [r["n_rows"] for r in split.fold_counts(split.with_fold(train, KEY)).collect()]
    assert len(counts) == 5 and max(counts) < 1.25 * min(counts)


def test_other_shares(rows):
    half = split.with_split(rows, KEY, train_percent=50).filter("split = 'train'").count()
    assert abs(half / 5000 - 0.5) < 0.04


def test_random_split_is_complete(rows):
    train, test = split.random_split(rows)
    assert train.count() + test.count() == 5000
    assert train.select("a").intersect(test.select("a")).count() == 0


def test_a_key_is_required():
    with pytest.raises(ValueError):
        hash_bucket([], 10)


def test_no_shuffle_in_split(rows, plan_of):
    plan = plan_of(split.with_fold(split.with_split(rows, KEY), KEY))
    assert "Exchange" not in plan and "Sort" not in plan
