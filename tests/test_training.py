import math
import pathlib

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from priceloom.catalog.base import KEY, prop_signal
from priceloom.plans import recipes, tuning
from priceloom.plans.boosting import BASIC, OPTIMIZED, Booster

QUICK = Booster(max_iter=10, max_depth=5, step_size=0.1, subsampling_rate=0.8, feature_subset="all", max_bins=32)
GRID = tuning.Grid(max_depth=(2,), max_iter=(2,), step_size=(0.1,))
TINY = QUICK.with_(max_iter=2, max_depth=2)


@pytest.fixture(scope="module")
def signal(spark):
    return prop_signal(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def optimized(signal):
    prepared = recipes.prepare(signal, recipes.OPTIMIZED_RECIPE.with_(booster=QUICK), row_key=KEY)
    yield recipes.fit(prepared)
    prepared.release()


def test_published_settings():
    assert (BASIC.max_iter, BASIC.max_depth, BASIC.step_size, BASIC.subsampling_rate) == (100, 5, 0.05, 0.8)
    assert (BASIC.feature_subset, BASIC.max_bins, BASIC.min_instances, BASIC.seed) == ("sqrt", 32, 1, 42)
    assert (OPTIMIZED.max_iter, OPTIMIZED.max_depth, OPTIMIZED.step_size) == (150, 7, 0.03)
    assert (OPTIMIZED.subsampling_rate, OPTIMIZED.feature_subset, OPTIMIZED.max_bins) == (0.7, "all", 40)


def test_estimator_carries_every_setting(spark):
    trees = OPTIMIZED.estimator()
    got = (
        trees.getMaxIter(),
        trees.getMaxDepth(),
        trees.getStepSize(),
        trees.getSubsamplingRate(),
        trees.getFeatureSubsetStrategy(),
        trees.getMaxBins(),
        trees.getMinInstancesPerNode(),
        trees.getSeed(),
    )
    assert got == (150, 7, 0.03, 0.7, "all", 40, 1, 42)


def test_quality_on_a_learnable_target(optimized):
    row = optimized.evaluate(optimized.prepared.test).first()
    assert row["r2_log"] >= 0.9 and row["r2_original"] >= 0.9
    assert row["adjusted_r2"] <= row["r2_log"] and row["feature_count"] == 4 + 4 + 3 + 3 + 2


def test_importances(optimized):
    rows = optimized.importances().collect()
    assert [r["feature"] for r in rows] == optimized.prepared.inputs
    assert all(r["importance"] >= 0 for r in rows)
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_scoring_keeps_every_test_row(optimized):
    scored = optimized.score(optimized.prepared.test)
    assert scored.count() == optimized.prepared.test.count()
    gap = scored.select(F.max(F.abs(F.log1p("exp_prediction") - F.col("prediction")))).first()[0]
    assert gap < 1e-9


def test_estimates_for_raw_listings(optimized, signal):
    """Listings without a price get the same estimates as prepared test rows."""
    raw = signal.drop("price").join(optimized.prepared.test.select(*KEY), list(KEY), "left_semi")
    columns = [*KEY, "exp_prediction"]
    estimates = optimized.estimate(raw).select(columns)
    known = optimized.score(optimized.prepared.test).select(columns)
    assert estimates.exceptAll(known).count() == 0 and estimates.count() == known.count()


def test_basic_skips_rows_with_nulls(signal):
    prepared = recipes.prepare(signal, recipes.BASIC_RECIPE.with_(booster=TINY), row_key=KEY)
    fitted = recipes.fit(prepared)
    complete = prepared.test.filter("living_area is not null")
    assert fitted.score(prepared.test).count() == complete.count() < prepared.test.count()
    prepared.release()


def test_unlabelled_rows_are_dropped_and_counted(spark):
    rows = [(i, float(i % 50), i % 5) for i in range(400)]
    rows += [(1000, None, 1), (1001, float("nan"), 1), (1002, -3.0, 1)]
    df = spark.createDataFrame(rows, "id int, price double, rooms int")
    prepared = recipes.prepare(df, recipes.BASIC_RECIPE.with_(booster=TINY), row_key=["id"])
    assert (prepared.n_rows, prepared.n_unlabelled, prepared.frame.count()) == (403, 3, 400)
    recipes.fit(prepared)
    prepared.release()


def test_outlier_statistics_scope(spark):
    """A huge test price widens the bounds only when test rows count."""
    df = spark.range(2000).selectExpr("id", "double(100 + id % 7) as price", "int(id % 3) as rooms")
    recipe = recipes.OPTIMIZED_RECIPE.with_(booster=TINY)
    base = recipes.prepare(df, recipe, row_key=["id"])
    test_id = base.test.agg(F.min("id")).first()[0]
    base.release()
    spiked = df.withColumn("price", F.when(F.col("id") == test_id, 1e12).otherwise(F.col("price")))
    for scope in ("all", "train"):
        prepared = recipes.prepare(spiked, recipe.with_(outlier_stats=scope), row_key=["id"])
        assert prepared.frame.count() == 1999
        prepared.release()


def test_bins_follow_the_widest_category(spark):
    df = spark.range(3000).selectExpr("id", "double(id % 100) as price", "concat('k', id % 50) as k")
    prepared = recipes.prepare(df, recipes.BASIC_RECIPE.with_(booster=TINY), row_key=["id"])
    fitted = recipes.fit(prepared)
    assert fitted.encoders.max_arity == 51
    assert fitted.model.stages[-1].getMaxBins() == 51
    prepared.release()


def test_encodings_are_the_callers_choice(spark, signal):
    """Ranks are the nominal indices as numbers; no label count changes them."""
    nominal = recipes.prepare(signal, recipes.TUNED_RECIPE, row_key=KEY)
    chosen = (("property_type", "rank"), ("city", "rank"))
    ranked = recipes.prepare(signal, recipes.TUNED_RECIPE.with_(encodings=chosen), row_key=KEY)
    assert ranked.encoded_as("rank") == ["property_type", "city"] and ranked.encoded_as("nominal") == []
    frames = []
    for prepared in (nominal, ranked):
        encoders = recipes.fit_encoders(prepared, prepared.train)
        vectors = recipes.vectors(prepared, encoders, prepared.test)
        frames.append(vectors.select(*KEY, vector_to_array("features").alias("features")))
    assert frames[0].exceptAll(frames[1]).count() == 0 and frames[0].count() == frames[1].count()
    fitted = recipes.fit(ranked, TINY)
    assert fitted.score(ranked.test).count() == ranked.test.count()
    scores = tuning.cross_validate(ranked, GRID)
    assert scores.count() == 5 and scores.filter("r2 is null").count() == 0
    nominal.release()
    ranked.release()
    with pytest.raises(ValueError, match="nowhere"):
        recipes.prepare(signal, recipes.TUNED_RECIPE.with_(encodings=(("nowhere", "rank"),)), row_key=KEY)
    with pytest.raises(ValueError, match="'property_type' has 3 labels"):
        recipes.fit(recipes.prepare(signal, recipes.TUNED_RECIPE.with_(max_labels=2), row_key=KEY))


def test_nothing_is_left_in_the_shared_folder(spark, signal):
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    names = lambda: {p.name for p in folder.iterdir() if p.name.startswith(("prepared", "widened"))}
    before = names()
    chosen = (("property_type", "rank"), ("city", "target_mean"))
    recipe = recipes.TUNED_RECIPE.with_(encodings=chosen, storage="table")
    prepared = recipes.prepare(signal, recipe, row_key=KEY)
    tuned = tuning.tune(prepared, GRID)
    assert tuned.fitted.score(prepared.test).count() == prepared.test.count()
    assert names() > before
    prepared.release()
    assert names() == before


@pytest.mark.parametrize(
    "row, name",
    [("'a' as city, 1.0D as city_indexed", "city_indexed"), ("2.0D as living_area, 'x' as living_area_squared", "living_area_squared")],
)
def test_clashing_names_raise(spark, row, name):
    df = spark.range(20).selectExpr("id", "double(id) as price", *row.split(", "))
    with pytest.raises(ValueError, match=name):
        recipes.prepare(df, recipes.OPTIMIZED_RECIPE, row_key=["id"])


def test_infinite_labels_are_dropped_and_counted(spark):
    rows = [(i, 100.0 + i % 5, i % 3) for i in range(300)]
    rows += [(900, float("inf"), 1), (901, float("-inf"), 1), (902, float("nan"), 1), (903, None, 1)]
    df = spark.createDataFrame(rows, "id int, price double, rooms int")
    prepared = recipes.prepare(df, recipes.OPTIMIZED_RECIPE.with_(booster=TINY), row_key=["id"])
    assert (prepared.n_unlabelled, prepared.frame.count()) == (4, 300)
    prepared.release()


def test_stored_as_a_table(signal):
    recipe = recipes.OPTIMIZED_RECIPE.with_(booster=TINY)
    kept = recipes.prepare(signal, recipe, row_key=KEY)
    table = recipes.prepare(signal, recipe.with_(storage="table"), row_key=KEY)
    assert table.frame.exceptAll(kept.frame).count() == 0 and table.frame.count() == kept.frame.count()
    assert recipes.fit(table).evaluate(table.test).first()["n"] == table.test.count()
    kept.release()


def test_without_a_key_the_whole_row_is_hashed(spark):
    df = spark.range(4000).selectExpr("id / 7 as price", "rand(3) as area")
    twice = df.union(df)
    prepared = recipes.prepare(twice, recipes.BASIC_RECIPE.with_(booster=TINY))
    sides = prepared.frame.groupBy("price", "area").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0
    assert abs(prepared.train.count() / 8000 - 0.8) < 0.03
    prepared.release()


def test_reserved_column_names_raise(spark):
    df = spark.createDataFrame([(1.0, 2)], "price double, fold int")
    with pytest.raises(ValueError, match="fold"):
        recipes.prepare(df, recipes.BASIC_RECIPE)


def test_types_frame_end_to_end(spark):
    """Booleans, decimals, dates and timestamps in one table."""
    df = spark.range(500).selectExpr(
        "int(id % 40) as price",
        "id % 2 = 0 as flag",
        "date'2024-01-01' as d",
        "timestamp'2024-01-01' as ts",
        "cast(id % 9 as decimal(8,2)) as dec",
        "concat('s', id % 4) as s",
        "int(id) as number",
    )
    prepared = recipes.prepare(df, recipes.OPTIMIZED_RECIPE.with_(booster=TINY))
    assert prepared.numeric == ("flag", "dec", "number") and prepared.plan.ignored == ("d", "ts")
    row = recipes.fit(prepared).evaluate(prepared.test).first()
    assert row["n"] > 0 and not math.isnan(row["rmse_log"])
    prepared.release()


def test_same_result_for_any_input_layout(spark, signal):
    """Prepared rows and their sides do not depend on how the input is split."""
    recipe = recipes.OPTIMIZED_RECIPE.with_(booster=TINY)
    a = recipes.prepare(signal, recipe, row_key=KEY)
    b = recipes.prepare(signal.repartition(5, "l_partkey"), recipe, row_key=KEY)
    columns = [*KEY, "split", "price"]
    assert a.frame.select(columns).exceptAll(b.frame.select(columns)).count() == 0
    assert a.frame.count() == b.frame.count()
    a.release()
    b.release()


def test_a_repeated_run_gives_the_same_model(signal):
    predictions = []
    for _ in range(2):
        prepared = recipes.prepare(signal, recipes.OPTIMIZED_RECIPE.with_(booster=TINY), row_key=KEY)
        scored = recipes.fit(prepared).score(prepared.test)
        predictions.append(scored.select(*KEY, "prediction").toPandas().sort_values(list(KEY)).to_numpy().tolist())
        prepared.release()
    assert predictions[0] == predictions[1]


def test_a_fixed_layout_gives_the_same_model_for_any_scan(spark, signal):
    """Subsampling is drawn per partition; with a layout of the recipe's own,
    neither input partitions nor cores change the estimates."""
    predictions = []
    recipe = recipes.OPTIMIZED_RECIPE.with_(booster=TINY, train_partitions=3)
    for rows in (signal, signal.repartition(7, "l_suppkey")):
        prepared = recipes.prepare(rows, recipe, row_key=KEY)
        assert prepared.frame.rdd.getNumPartitions() == 3
        scored = recipes.fit(prepared).score(prepared.test)
        predictions.append(scored.select(*KEY, "prediction").toPandas().sort_values(list(KEY)).to_numpy().tolist())
        prepared.release()
    assert predictions[0] == predictions[1]


def test_preparation_moves_no_rows_by_default(spark, signal, plan_of):
    prepared = recipes.prepare(signal, recipes.OPTIMIZED_RECIPE.with_(storage="table"), row_key=KEY)
    laid_out = recipes._laid_out(signal, None, KEY)
    assert laid_out is signal and "Exchange" not in plan_of(prepared.frame)
    prepared.release()


def test_rows_of_a_fit_without_subsample_spread_over_bounded_partitions(spark, monkeypatch):
    from priceloom.plans import recipes as plans

    rows = spark.createDataFrame(
        [(i, 1000.0 + 3 * i, float(i % 7), float(i % 3), "ab"[i % 2]) for i in range(400)],
        "id long, price double, rooms double, baths double, kind string",
    ).coalesce(1)
    monkeypatch.setattr(plans, "ROWS_PER_PARTITION", 50)
    whole = plans.BASIC_RECIPE.with_(booster=plans.BASIC.with_(subsampling_rate=1.0, max_iter=2))
    prepared = plans.prepare(rows, whole, target="price", row_key=("id",))
    try:
        assert prepared.frame.rdd.getNumPartitions() == 8
        assert prepared.frame.count() == 400
    finally:
        prepared.release()
    sampled = plans.prepare(rows, plans.BASIC_RECIPE, target="price", row_key=("id",))
    try:
        assert sampled.frame.rdd.getNumPartitions() == 1
    finally:
        sampled.release()
