import math

from pyspark.sql import functions as F

from priceloom.operators import clean
from priceloom.operators.schema import plan_columns

INF, NAN = float("inf"), float("nan")


def values(df, column):
    return [r[column] for r in df.select(column).collect()]


def test_log_target_edges(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,), (None,)], "price double")
    assert values(clean.with_log_target(df, "price"), "log_price") == [None, None, 0.0, None]


def test_log_target_replaces_a_stale_column(spark):
    df = spark.createDataFrame([(math.e - 1, 9.0)], "price double, log_price double")
    logged = clean.with_log_target(df, "price")
    assert logged.columns == ["price", "log_price"]
    assert abs(logged.first()["log_price"] - 1) < 1e-12


def test_fill_changes_nulls_only(spark):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,), (INF,)], "a double")
    filled = values(clean.fill_nulls(df, ["a"]), "a")
    assert filled[:2] == [1.0, 0.0] and math.isnan(filled[2]) and filled[3] == INF


def test_fill_keeps_types(spark):
    types = {"i": "int", "l": "bigint", "d": "decimal(10,2)", "f": "float"}
    df = spark.sql("select " + ", ".join(f"cast(null as {t}) as {c}" for c, t in types.items()))
    assert clean.fill_nulls(df, df.columns).dtypes == df.dtypes


def test_booleans_become_numbers(spark):
    df = spark.createDataFrame([(1, True), (2, None)], "price int, flag boolean")
    plan = plan_columns(df.schema)
    fixed = clean.fill_nulls(clean.booleans_as_numbers(df, plan), plan.numeric)
    assert values(fixed, "flag") == [1, 0]


def test_invalid_rows_go(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (NAN,), (INF,), (None,)], "a double")
    assert values(clean.drop_invalid(df, ["a"]), "a") == [1.0, 0.0, INF]


def test_one_row_has_no_bounds_and_stays(spark):
    df = clean.with_log_target(spark.createDataFrame([(1.0,)], "price double"), "price")
    assert clean.target_stats(df).first()["stddev"] is None
    assert clean.keep_within_sigma(df).count() == 1


def test_nan_and_null_prices_go_before_the_statistics(spark):
    df = spark.createDataFrame([(10.0,), (12.0,), (NAN,), (None,)], "price double")
    kept = clean.keep_within_sigma(clean.with_log_target(df, "price"))
    assert sorted(values(kept, "price")) == [10.0, 12.0]


def test_outliers_on_the_log_scale(spark):
    df = spark.createDataFrame([(100.0 + i,) for i in range(200)] + [(1e9,), (-5.0,)], "price double")
    logged = clean.with_log_target(df, "price")
    kept = clean.keep_within_sigma(logged)
    assert kept.count() == 200 and kept.agg(F.max("price")).first()[0] < 1e9
    assert tuple(clean.outlier_counts(logged).first()) == (202, 200, 2, 1)


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    inside = df.filter(clean.inside("x", F.lit(0.0), F.lit(2.0)))
    assert inside.count() == 2


def test_statistics_from_other_rows(spark):
    df = spark.createDataFrame([(float(i), i < 10) for i in range(1000)], "x double, train boolean")
    kept = clean.keep_within_sigma(df, "x", fit_on=df.filter("train"))
    assert kept.agg(F.max("x")).first()[0] == 13.0


def test_outlier_filter_plan_has_no_join(spark, plan_of, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey", "l_extendedprice as price")
    plan = plan_of(clean.keep_within_sigma(clean.with_log_target(df, "price")))
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert "l_comment" not in plan and "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_infinite_and_nan_bounds_do_not_restrict(spark):
    df = spark.createDataFrame([(float(i % 4),) for i in range(40)] + [(float("inf"),), (None,)], "v double")
    assert clean.keep_within_sigma(df, "v").count() == 40
    assert clean.target_stats(df, "v").first()["n"] == 40
    row = clean.outlier_counts(df, "v").first()
    assert (row["n_rows"], row["n_kept"], row["n_unlabelled"]) == (42, 40, 2)
    nan = F.lit(float("nan"))
    assert df.filter(clean.inside("v", nan, nan)).count() == 40
