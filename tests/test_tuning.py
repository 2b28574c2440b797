import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from priceloom.catalog.base import KEY, prop_signal
from priceloom.operators import split
from priceloom.plans import recipes, tuning
from priceloom.plans.boosting import Booster

BASE = Booster(max_iter=4, max_depth=2, step_size=0.1, subsampling_rate=0.8, feature_subset="sqrt", max_bins=32)
GRID = tuning.Grid(max_depth=(1, 3), max_iter=(2, 4), step_size=(0.1, 0.3))


@pytest.fixture(scope="module")
def prepared(spark):
    recipe = recipes.TUNED_RECIPE.with_(booster=BASE, folds=3)
    prepared = recipes.prepare(prop_signal(spark, "/root/testdata/sf0.001"), recipe, row_key=KEY)
    yield prepared
    prepared.release()


def test_published_grid(spark):
    points = tuning.GRID.points()
    assert len(points) == len(set(points)) == 18
    maps = tuning.GRID.param_maps(BASE.estimator())
    got = {tuple(v for _, v in sorted((p.name, v) for p, v in m.items())) for m in maps}
    assert got == set(points)  # maxDepth, maxIter, stepSize sort in grid order


def test_same_scores_as_spark_cross_validator(spark, prepared):
    """The shared-prefix search against one fit per grid point and fold."""
    scores = tuning.cross_validate(prepared, GRID)
    assert scores.count() == 8 * 3
    mine = {
        (r["max_depth"], r["max_iter"], r["step_size"]): r["mean_r2"] for r in tuning.mean_scores(scores).collect()
    }

    train = prepared.train
    assert train.exceptAll(split.with_fold(train, KEY, 3)).count() == 0
    encoders = recipes.fit_encoders(prepared, train)
    vectors = recipes.vectors(prepared, encoders, train).select("features", "log_price", "fold")
    trees = BASE.estimator(max_arity=encoders.max_arity)
    maps = GRID.param_maps(trees)
    evaluator = RegressionEvaluator(labelCol="log_price", predictionCol="prediction", metricName="r2")
    validator = CrossValidator(
        estimator=trees, estimatorParamMaps=maps, evaluator=evaluator, numFolds=3, foldCol="fold", parallelism=4
    )
    model = validator.fit(vectors)
    theirs = {
        (m[trees.maxDepth], m[trees.maxIter], m[trees.stepSize]): s for m, s in zip(maps, model.avgMetrics)
    }
    assert mine.keys() == theirs.keys()
    for point, score in theirs.items():
        assert mine[point] == pytest.approx(score, abs=1e-9)


def test_best_point_prefers_the_smaller_model_on_ties(spark):
    rows = [(5, 10, 0.1, f, 0.8) for f in range(2)] + [(3, 20, 0.1, f, 0.8) for f in range(2)] + [(3, 10, 0.1, 0, 0.2)]
    best = tuning.best_point(spark.createDataFrame(rows, tuning.SCORES_SCHEMA)).first()
    assert (best["max_depth"], best["max_iter"], best["mean_r2"]) == (3, 20, pytest.approx(0.8))


def test_tune_refits_the_best_point(prepared):
    tuned = tuning.tune(prepared, GRID)
    best = tuning.best_point(tuned.scores).first()
    trees = tuned.fitted.model.stages[-1]
    assert (trees.getMaxDepth(), trees.getNumTrees) == (best["max_depth"], best["max_iter"])
    assert tuned.best == (best["max_depth"], best["max_iter"], best["step_size"])
    row = tuning.stability(tuned.fitted.evaluate(prepared.test), tuned.best_score).first()
    assert row["gap"] == pytest.approx(abs(row["cv_r2"] - row["test_r2"]))
    assert row["cv_r2"] == tuned.scores.groupBy("max_depth", "max_iter", "step_size").agg(
        F.avg("r2").alias("m")
    ).agg(F.max("m")).first()[0]


def test_search_plan_accounts_for_every_row(prepared):
    rows = tuning.search_plan(prepared.train, KEY, GRID, 3).collect()
    total = prepared.train.count()
    assert len(rows) == 8 * 3
    assert all(r["fit_rows"] + r["held_rows"] == total for r in rows)
    assert sum(r["held_rows"] for r in rows) == 8 * total
