import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from priceloom.operators import market, metrics


@pytest.fixture
def scored(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (5.0, 6.0)]
    return spark.createDataFrame(rows, "log_price double, prediction double")


def test_known_scores(scored):
    row = metrics.regression_metrics(scored).first()
    assert row["n"] == 4
    assert (row["r2"], row["rmse"], row["mae"]) == pytest.approx((0.775, 0.75, 0.625))


def test_same_as_the_evaluator(spark):
    df = spark.range(4000).select(
        (F.rand(1) * 5 + 1e6).alias("log_price"), (F.rand(2) + 1e6).alias("prediction")
    ).persist()
    row = metrics.regression_metrics(df).first()
    for name in ("r2", "rmse", "mae"):
        evaluator = RegressionEvaluator(labelCol="log_price", predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(df), rel=1e-6)
    df.unpersist()


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "log_price double, prediction double")
    assert metrics.regression_metrics(df).first()["r2"] is None


def test_adjusted_r2(scored):
    base = metrics.regression_metrics(scored)
    row = metrics.with_adjusted_r2(base, 1).first()
    assert row["adjusted_r2"] == pytest.approx(1 - 0.225 * 3 / 2) and row["adjusted_r2"] <= row["r2"]
    assert metrics.with_adjusted_r2(base, 3).first()["adjusted_r2"] is None
    assert metrics.with_adjusted_r2(base, 9).first()["adjusted_r2"] is None


def test_all_scores_are_one_aggregate(scored, plan_of):
    priced = metrics.with_exp_prediction(scored).withColumn("price", F.expm1("log_price"))
    frame = metrics.all_metrics(priced, "price", 1)
    assert plan_of(frame).count("HashAggregate") == 2
    row = frame.first()
    assert row["r2_log"] == pytest.approx(0.775) and row["rmse_original"] > 0


def test_relative_score(spark):
    df = spark.createDataFrame([("ours", 0.6), ("theirs", 0.8)], "model string, r2 double")
    assert tuple(metrics.relative_score(df, "r2", "ours", "theirs").first()) == pytest.approx((0.6, 0.8, 0.75))


def test_mispriced(spark):
    listings = [(1, 130.0, 100.0), (2, 70.0, 100.0), (3, 110.0, 100.0), (4, 5.0, 0.0)]
    df = spark.createDataFrame(listings, "id int, price double, fair double")
    rows = {r["id"]: r["verdict"] for r in market.mispriced(df, "price", "fair").collect()}
    assert rows == {1: "overvalued", 2: "undervalued"}


def test_price_by_region(spark):
    df = spark.createDataFrame([("n", 1.0), ("n", 3.0), ("s", 5.0)], "region string, price double")
    rows = {r["region"]: tuple(r)[1:] for r in market.price_by_region(df, "price", "region").collect()}
    assert rows["n"] == pytest.approx((2, 2.0, 2 ** 0.5)) and rows["s"] == (1, 5.0, None)
