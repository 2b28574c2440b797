"""Training, scoring, importance and tuning over ``prop_signal``.

Boosted trees have no SQL equivalent in general, but depth-1 trees over features
with few values do: each round is the best threshold of grouped sums. Those
queries check splitting, labels, boosting and folds to the last row."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from priceloom.catalog import exact_trees
from priceloom.catalog.base import (
    FOLD_BUCKET,
    KEY,
    KEYS,
    PROP_CTE,
    SIGNAL_CTE,
    SPLIT_CASE,
    prop,
    prop_signal,
    query,
)
from priceloom.operators import split
from priceloom.plans import bundle, recipes, report, tuning
from priceloom.plans.boosting import Booster
from priceloom.plans.ledger import Ledger
from priceloom.sources.scratch import scratch_path, written

# The layout of the registered programs' training rows, part of their result.
PARTITIONS = 4
BASIC_RECIPE = recipes.BASIC_RECIPE.with_(train_partitions=PARTITIONS)
OPTIMIZED_RECIPE = recipes.OPTIMIZED_RECIPE.with_(train_partitions=PARTITIONS)

STUMP_FEATURES = ("bedrooms", "bathrooms", "land_area")
STUMPS = Booster(
    max_iter=2, max_depth=1, step_size=0.1, subsampling_rate=1.0, feature_subset="all", max_bins=32
)
STUMP_RECIPE = recipes.BASIC_RECIPE.with_(name="stumps", booster=STUMPS)
STUMP_GRID = tuning.Grid(max_depth=(1,), max_iter=(1, 2), step_size=(0.05, 0.1))


def _stump_rows(spark, sf_dir):
    rows = prop_signal(spark, sf_dir).select(*KEY, "price", *STUMP_FEATURES)
    return recipes.prepare(rows, STUMP_RECIPE, row_key=KEY)


def _finish(prepared, rows, name):
    """Store rows that still read the prepared ones, then give those up."""
    try:
        return written(rows, name)
    finally:
        prepared.release()


def _tree_sql(tree: str, rows: str, label: str) -> str:
    """CTEs ``<tree>``: per k, the feature f, threshold thr, leaf means lo and
    hi, and gain (squared error removed) of the best split of ``label`` over the
    rows not held out."""
    unpivot = " union all ".join(
        f"select k, {i} as f, cast({c} as double) as v, {label} as t from {rows} where not held"
        for i, c in enumerate(STUMP_FEATURES)
    )
    return (
        f"{tree}_bins as (select k, f, v, count(*) as n, sum(t) as s from ({unpivot}) group by k, f, v), "
        f"{tree}_cum as (select k, f, v, lead(v) over w as nv, sum(n) over w as nl, sum(s) over w as sl, "
        f"sum(n) over (partition by k, f) as nt, sum(s) over (partition by k, f) as st from {tree}_bins "
        "window w as (partition by k, f order by v)), "
        f"{tree} as (select k, f, (v + nv) / 2 as thr, sl / nl as lo, (st - sl) / (nt - nl) as hi, "
        f"sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt as gain from {tree}_cum "
        "where nv is not null qualify row_number() over "
        "(partition by k order by gain desc) = 1)"
    )


def _leaf_sql(tree: str) -> str:
    feature = " ".join(f"when {i} then {c}" for i, c in enumerate(STUMP_FEATURES))
    return f"case when (case {tree}.f {feature} end) <= {tree}.thr then {tree}.lo else {tree}.hi end"


def _stump_ctes(sides: str) -> str:
    """Two boosting rounds over ``sides`` (k, held, keys, y, features): the
    second tree is fitted to twice the residual of the first."""
    return (
        f"with {SIGNAL_CTE}, keyed as (select {KEYS}, ln(1 + price) as y, {', '.join(STUMP_FEATURES)}, "
        f"{SPLIT_CASE} as split, {FOLD_BUCKET} as fold from prop), sides as ({sides}), "
        f"{_tree_sql('t1', 'sides', 'y')}, "
        f"r1 as (select sides.*, {_leaf_sql('t1')} as p1 from sides join t1 using (k)), "
        f"{_tree_sql('t2', 'r1', '2 * (y - p1)')}, "
        f"r2 as (select r1.*, {_leaf_sql('t2')} as p2 from r1 join t2 using (k)) "
    )


_TEST_SIDES = "select 0 as k, split = 'test' as held, * from keyed"


@query(
    _stump_ctes(_TEST_SIDES)
    + f"select {KEYS}, round(p1 + 0.1 * p2, 6) as prediction from r2 where held"
)
def gbt_first_rounds(spark, sf_dir):
    """Two rounds of depth-1 trees: test predictions match to the row."""
    prepared = _stump_rows(spark, sf_dir)
    scored = recipes.fit(prepared).score(prepared.test)
    return _finish(prepared, scored.select(*KEY, F.round("prediction", 6).alias("prediction")), "scores")


# Scores of the two-round model on its test rows, one row.
_STUMP_SCORES = (
    _stump_ctes(_TEST_SIDES)
    + ", scored as (select y, p1 + 0.1 * p2 as p, exp(y) - 1 as price, exp(p1 + 0.1 * p2) - 1 as ep "
    "from r2 where held), "
    "s as (select count(*) as n, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) as r2_log, sqrt(avg((y - p) ** 2)) "
    "as rmse_log, avg(abs(y - p)) as mae_log, 1 - sum((price - ep) ** 2) / (var_pop(price) * count(*)) as r2_original, "
    "sqrt(avg((price - ep) ** 2)) as rmse_original from scored), "
    "a as (select *, 1 - (1 - r2_log) * (n - 1) / (n - 4) as adjusted_r2 from s) "
)


@query(
    f"{_STUMP_SCORES} select n, round(r2_log, 6) as r2_log, round(rmse_log, 6) as rmse_log, "
    "round(mae_log, 6) as mae_log, round(r2_original, 6) as r2_original, "
    "round(rmse_original, 4) as rmse_original, cast(3 as bigint) as feature_count, "
    "round(adjusted_r2, 6) as adjusted_r2 from a"
)
def gbt_first_rounds_metrics(spark, sf_dir):
    """Every score of the same model on its test rows."""
    prepared = _stump_rows(spark, sf_dir)
    scores = recipes.fit(prepared).evaluate(prepared.test)
    digits = {c: 4 if c == "rmse_original" else 6 for c in scores.columns if c not in ("n", "feature_count")}
    return _finish(prepared, scores.withColumns({c: F.round(c, d) for c, d in digits.items()}), "scores")


# A feature's importance is its share of the squared error all splits remove.
_STUMP_IMPORTANCES = (
    ", names as (select * from (values "
    + ", ".join(f"({i}, '{name}')" for i, name in enumerate(STUMP_FEATURES))
    + ") v(f, feature)), removed as (select f, gain from t1 union all select f, gain from t2), "
    "weights as (select feature, f, coalesce(sum(gain), 0) / (select sum(gain) from removed) as importance "
    "from names left join removed using (f) group by feature, f), "
    "ranked as (select feature, importance, "
    "cast(row_number() over (order by importance desc, f) as int) as rank from weights) "
)


@query(
    _stump_ctes(_TEST_SIDES)
    + _STUMP_IMPORTANCES
    + "select rank, feature, round(importance, 6) as importance from ranked"
)
def gbt_first_rounds_importance(spark, sf_dir):
    """Ranked importances of the same model."""
    prepared = _stump_rows(spark, sf_dir)
    fitted = recipes.fit(prepared)
    prepared.release()
    ranked = report.importance_topk(fitted.importances())
    return ranked.withColumn("importance", F.round("importance", 6))


def _report_sql() -> str:
    sizes = "(select count(*) from keyed where split = '{}')"
    blocks = {
        "dataset": [
            ("rows", "(select count(*) from keyed)"),
            ("columns", "8"),
            ("numeric_features", "3"),
            ("categorical_features", "0"),
            ("unlabelled_rows", "0"),
            ("outlier_rows", "0"),
            ("train_rows", sizes.format("train")),
            ("test_rows", sizes.format("test")),
            ("scored_rows", "n"),
        ],
        "training": [("boosting_rounds", "2"), ("max_bins", "32"), ("widest_nominal", "0")],
        "log_scale": [("r2", "r2_log"), ("rmse", "rmse_log"), ("mae", "mae_log")],
        "original_scale": [("r2", "r2_original"), ("rmse", "rmse_original")],
        "advanced": [("adjusted_r2", "adjusted_r2"), ("feature_count", "3")],
    }
    rows = [
        f"select '{section}' as section, {i} as position, '{metric}' as metric, "
        f"round(cast({sql} as double), 4) as value from a"
        for section, lines in blocks.items()
        for i, (metric, sql) in enumerate(lines, start=1)
    ]
    rows.append("select 'importance', rank, feature, round(importance, 4) from ranked")
    return f"{_STUMP_SCORES} {_STUMP_IMPORTANCES} " + " union all ".join(rows)


@query(_report_sql())
def report_first_rounds(spark, sf_dir):
    """The whole report of the same model, its fit time aside."""
    rows = prop_signal(spark, sf_dir).select(*KEY, "price", *STUMP_FEATURES)
    lines = report.run(rows, STUMP_RECIPE, row_key=KEY).filter("metric <> 'fit_seconds' and section <> 'phases'")
    return lines.withColumn("value", F.round("value", 4))


_FOLD_SIDES = (
    "select cast(r.k as bigint) as k, fold = r.k as held, keyed.* from keyed, range(5) r(k) where split = 'train'"
)
# Every (k, max_iter, step_size) with the R2 on the rows k holds out.
_STUMP_R2 = (
    ", scored as (select k, max_iter, step_size, y, p1 + case when max_iter = 2 then step_size * p2 else 0 end as p "
    "from r2, (values (1), (2)) n(max_iter), (values (cast(0.05 as double)), (cast(0.1 as double))) s(step_size) "
    "where held), per as (select k, max_iter, step_size, 1 - avg((y - p) ** 2) / var_pop(y) as score from scored "
    "group by k, max_iter, step_size) "
)


@query(
    _stump_ctes(_FOLD_SIDES)
    + _STUMP_R2
    + "select 1 as max_depth, max_iter, step_size, cast(k as int) as fold, round(score, 6) as r2 from per"
)
def cv_scores_stumps(spark, sf_dir):
    """Five folds over a grid of depth-1 models, every score checked."""
    prepared = _stump_rows(spark, sf_dir)
    scores = tuning.cross_validate(prepared, STUMP_GRID)
    prepared.release()
    return scores.withColumn("r2", F.round("r2", 6))


@query(
    _stump_ctes(_FOLD_SIDES)
    + _STUMP_R2
    + "select 1 as max_depth, max_iter, step_size, cast(k as int) as fold, round(score, 6) as r2, "
    "step_size < 0.1 as reused from per"
)
def cv_resumed_stumps(spark, sf_dir):
    """The same search in two runs with one ledger: the second finds the fits of
    the smaller step, does the others, and has the scores of the whole."""
    prepared = _stump_rows(spark, sf_dir)
    path = scratch_path(spark, "ledger")
    half = tuning.Grid(STUMP_GRID.max_depth, STUMP_GRID.max_iter, STUMP_GRID.step_size[:1])
    tuning.cross_validate(prepared, half, ledger=Ledger(spark, path))
    before = Ledger(spark, path).table().select("fold", "max_depth", "step_size").distinct()
    before = written(before.withColumn("reused", F.lit(True)), "reused")
    scores = tuning.cross_validate(prepared, STUMP_GRID, ledger=Ledger(spark, path))
    prepared.release()
    marked = scores.join(F.broadcast(before), ["fold", "max_depth", "step_size"], "left")
    reused = F.coalesce("reused", F.lit(False)).alias("reused")
    return marked.select("max_depth", "max_iter", "step_size", "fold", F.round("r2", 6).alias("r2"), reused)


@query(
    _stump_ctes(f"{_FOLD_SIDES} union all select 5, split = 'test', * from keyed")
    + _STUMP_R2
    + ", means as (select max_iter, step_size, avg(score) as mean from per where k < 5 group by max_iter, step_size), "
    "best as (select * from means order by mean desc, max_iter, step_size limit 1) "
    "select round(mean, 6) as cv_r2, round(score, 6) as test_r2, round(abs(mean - score), 6) as gap "
    "from best join per using (max_iter, step_size) where k = 5"
)
def cv_stability_stumps(spark, sf_dir):
    """The same search, its winner refitted on all training rows and tested."""
    prepared = _stump_rows(spark, sf_dir)
    tuned = tuning.tune(prepared, STUMP_GRID)
    gap = tuning.stability(tuned.fitted.evaluate(prepared.test), tuned.best_score)
    return _finish(prepared, gap.select(*[F.round(c, 6).alias(c) for c in gap.columns]), "gap")


_DERIVED = {
    "living_area_squared": "living_area * living_area",
    "bedrooms_squared": "bedrooms * bedrooms",
    "bathrooms_squared": "cast(bathrooms as double) * bathrooms",
    "land_area_squared": "cast(land_area as double) * land_area",
    "living_land_ratio": "case when land_area > 0 then living_area / land_area else 0 end",
    "bed_bath_ratio": "case when bathrooms > 0 then bedrooms / bathrooms else 0 end",
    "area_per_bedroom": "case when bedrooms > 0 then living_area / bedrooms else 0 end",
    "living_area_x_bathrooms": "living_area * bathrooms",
    "bedrooms_x_bathrooms": "bedrooms * bathrooms",
    "living_area_x_land_area": "living_area * land_area",
}
_PREPARED = (
    f"with {PROP_CTE}, logged as (select {KEYS}, price, coalesce(living_area, 0) as living_area, bedrooms, bathrooms, "
    f"land_area, property_type, city, ln(1 + price) as log_price, {SPLIT_CASE} as split, "
    f"cast({FOLD_BUCKET} as int) as fold from prop), "
    "bounds as (select avg(log_price) - 3 * stddev_samp(log_price) as lower, "
    "avg(log_price) + 3 * stddev_samp(log_price) as upper from logged) "
)


@query(
    f"{_PREPARED} select {KEYS}, price, living_area, bedrooms, bathrooms, land_area, property_type, city, "
    + "round(log_price, 6) as log_price, split, fold, "
    + ", ".join(f"round({sql}, 6) as {name}" for name, sql in _DERIVED.items())
    + " from logged, bounds where log_price >= lower and log_price <= upper"
)
def prepared_rows(spark, sf_dir):
    """The optimized program's preparation as a whole: filled, filtered, derived
    and split rows as they enter the model."""
    prepared = recipes.prepare(prop(spark, sf_dir), recipes.OPTIMIZED_RECIPE, row_key=KEY)
    rows = prepared.frame.withColumns({c: F.round(c, 6) for c in ("log_price", *_DERIVED)})
    return _finish(prepared, rows, "prepared")


@query(
    f"with {PROP_CTE}, folds as (select cast({FOLD_BUCKET} as int) as fold, count(*) as n from prop "
    f"where {SPLIT_CASE} = 'train' group by 1) "
    "select fold, cast((select sum(n) from folds) - n as bigint) as fit_rows, n as held_rows, "
    "max_depth, max_iter, cast(step_size as double) as step_size from folds, "
    "(values (3), (5), (7)) d(max_depth), (values (50), (100), (150)) i(max_iter), (values (0.05), (0.1)) s(step_size)"
)
def param_grid(spark, sf_dir):
    """The published search grid over five folds, with the rows of each fit."""
    train = split.with_split(prop(spark, sf_dir), KEY).filter(F.col(split.SPLIT) == "train")
    return tuning.search_plan(train, KEY)


def _exact_lines(lines):
    """What of a report SQL can state, whatever trees were grown: the dataset,
    training and feature-count lines, and whether the scores hang together."""
    value = lambda section, metric: F.max(
        F.when((F.col("section") == section) & (F.col("metric") == metric), F.col("value"))
    )
    weight = F.when(F.col("section") == "importance", F.col("value"))
    exact = lines.filter("section in ('dataset', 'training') and metric <> 'fit_seconds' or metric = 'feature_count'")
    n, features = value("dataset", "scored_rows"), value("advanced", "feature_count")
    adjusted = 1 - (1 - value("log_scale", "r2")) * (n - 1) / (n - features - 1)
    ranked = F.sort_array(F.collect_list(F.struct(F.col("position"), weight.alias("w"))))
    falls = F.forall(F.sequence(F.lit(1), F.size("ranked") - 1), lambda i: F.get("ranked.w", i - 1) >= F.get("ranked.w", i))
    checks = lines.agg(
        (F.abs(adjusted - value("advanced", "adjusted_r2")) < 1e-9).alias("adjusted_r2_follows"),
        (value("log_scale", "rmse") >= value("log_scale", "mae")).alias("rmse_at_least_mae"),
        (value("log_scale", "r2") > 0.9).alias("target_is_learned"),
        (F.sum(weight) <= 1 + 1e-9).alias("importances_within_one"),
        F.filter(ranked, lambda x: x["w"].isNotNull()).alias("ranked"),
    ).withColumn("importances_fall", falls)
    names = [c for c in checks.columns if c != "ranked"]
    rows = [
        F.struct(F.lit("check").alias("section"), F.lit(i).alias("position"), F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(names, start=1)
    ]
    return exact.unionByName(checks.select(F.inline(F.array(*rows))))


def _program_sql(filled: bool, numeric: int, rounds: int, bins: int) -> str:
    """The same lines for a program over prop_signal."""
    kept = "log_price between lower and upper" if filled else "true"
    scored = "true" if filled else "living_area is not null"
    lines = {
        "dataset": {
            "rows": "count(*)",
            "columns": f"max({len(KEY) + 7})",
            "numeric_features": f"max({numeric})",
            "categorical_features": "max(2)",
            "unlabelled_rows": "count(*) filter (where log_price is null)",
            "outlier_rows": f"count(*) filter (where not ({kept}))",
            "train_rows": f"count(*) filter (where {kept} and split = 'train')",
            "test_rows": f"count(*) filter (where {kept} and split = 'test')",
            "scored_rows": f"count(*) filter (where {kept} and split = 'test' and {scored})",
        },
        "training": {
            "boosting_rounds": f"max({rounds})",
            "max_bins": f"max({bins})",
            "widest_nominal": "1 + greatest(count(distinct property_type) filter (where split = 'train'), "
            "count(distinct city) filter (where split = 'train'))",
        },
    }
    rows = [
        f"select '{section}' as section, {i} as position, '{metric}' as metric, cast({sql} as double) as value from logged, bounds"
        for section, metrics in lines.items()
        for i, (metric, sql) in enumerate(metrics.items(), start=1)
    ]
    rows.append(f"select 'advanced', 2, 'feature_count', cast({numeric + 2} as double)")
    names = (
        "adjusted_r2_follows", "rmse_at_least_mae", "target_is_learned", "importances_within_one", "importances_fall",
    )
    rows += [f"select 'check', {i}, '{name}', cast(1 as double)" for i, name in enumerate(names, start=1)]
    return (
        f"with {SIGNAL_CTE}, logged as (select *, ln(1 + price) as log_price, {SPLIT_CASE} as split from prop), "
        "bounds as (select avg(log_price) - 3 * stddev_samp(log_price) as lower, "
        "avg(log_price) + 3 * stddev_samp(log_price) as upper from logged) " + " union all ".join(rows)
    )


@query(_program_sql(False, 4, 100, 32))
def gbt_basic(spark, sf_dir):
    """The basic program with its published settings: what SQL can state of its
    report, and that the scores hang together."""
    return _exact_lines(report.run(prop_signal(spark, sf_dir), BASIC_RECIPE, row_key=KEY))


@query(_program_sql(True, 14, 150, 40))
def gbt_optimized(spark, sf_dir):
    """The optimized program with its published settings, likewise."""
    return _exact_lines(report.run(prop_signal(spark, sf_dir), OPTIMIZED_RECIPE, row_key=KEY))


def _kind_sql(kind: str) -> str:
    """Test rows with both encoded categories; fitted on the training rows."""
    per = " union all ".join(
        f"select '{c}' as c, {c} as label, log_price from logged where split = 'train'" for c in ("property_type", "city")
    )
    if kind == "rank":
        value = "row_number() over (partition by c order by count(*) desc, label) - 1"
    else:
        value = "(sum(log_price) + 10 * (select avg(log_price) from logged where split = 'train')) / (count(*) + 10)"
    return (
        f"with {SIGNAL_CTE}, logged as (select *, ln(1 + price) as log_price, {SPLIT_CASE} as split from prop), "
        f"codes as (select c, label, cast({value} as double) as code from ({per}) group by c, label) "
        f"select {KEYS}, round(a.code, 6) as property_type, round(b.code, 6) as city from logged "
        "join codes a on a.c = 'property_type' and a.label = property_type "
        "join codes b on b.c = 'city' and b.label = city where split = 'test'"
    )


def _encoded(spark, sf_dir, kind):
    """The vectors that a program with this encoding sees, its last two parts."""
    recipe = recipes.TUNED_RECIPE.with_(encodings=(("property_type", kind), ("city", kind)))
    prepared = recipes.prepare(prop_signal(spark, sf_dir), recipe, row_key=KEY)
    made = recipes.vectors(prepared, recipes.fit_encoders(prepared, prepared.train), prepared.test)
    codes = vector_to_array("features")
    rows = made.select(
        *KEY, F.round(F.get(codes, F.lit(4)), 6).alias("property_type"), F.round(F.get(codes, F.lit(5)), 6).alias("city")
    )
    return _finish(prepared, rows, "encoded")


@query(_kind_sql("rank"))
def encoded_rank(spark, sf_dir):
    """Categories as frequency ranks, chosen in the recipe."""
    return _encoded(spark, sf_dir, "rank")


@query(_kind_sql("target_mean"))
def encoded_target_mean(spark, sf_dir):
    """Categories as smoothed means of the log target, chosen in the recipe."""
    return _encoded(spark, sf_dir, "target_mean")


_FOLD_MEANS = (
    f"with {SIGNAL_CTE}, logged as (select *, ln(1 + price) as y, {SPLIT_CASE} as split, {FOLD_BUCKET} as fold from prop), "
    "train as (select * from logged where split = 'train'), "
    "own as (select fold, count(*) as n, sum(y) as s from train group by fold), "
    "overall as (select own.fold, (t.s - own.s) / (t.n - own.n) as mean from own, (select sum(n) as n, sum(s) as s from own) t "
    "union all select -1, sum(s) / sum(n) from own), "
    + ", ".join(
        f"{c}_sums as (select {c} as label, count(*) as n, sum(y) as s from train group by 1), "
        f"{c}_own as (select {c} as label, fold, count(*) as n, sum(y) as s from train group by 1, 2), "
        f"{c}_means as (select o.fold, a.label, case when a.n > coalesce(b.n, 0) then (a.s - coalesce(b.s, 0) + 10 * mean) "
        f"/ (a.n - coalesce(b.n, 0) + 10) else mean end as code from {c}_sums a cross join overall o "
        f"left join {c}_own b on b.label = a.label and b.fold = o.fold)"
        for c in ("property_type", "city", "street")
    )
    + f" select {KEYS}, split, "
    + ", ".join(f"round(coalesce({c}_means.code, mean), 6) as {c}" for c in ("property_type", "city", "street"))
    + " from logged join overall o on o.fold = case when split = 'train' then logged.fold else -1 end "
    + " ".join(f"left join {c}_means on {c}_means.fold = o.fold and {c}_means.label = logged.{c}" for c in ("property_type", "city", "street"))
)


@query(_FOLD_MEANS.replace("from lineitem)", ", 'street-' || (l_orderkey % 700) as street from lineitem)", 1))
def encoded_fold_mean(spark, sf_dir):
    """Categories as means over the other folds: every training row without its
    own fold, every test row over all of them."""
    columns = ("property_type", "city", "street")
    rows = prop_signal(spark, sf_dir, "concat('street-', l_orderkey % 700) as street")
    recipe = recipes.TUNED_RECIPE.with_(encodings=tuple((c, "fold_mean") for c in columns))
    prepared = recipes.prepare(rows, recipe, row_key=KEY)
    encoders = recipes.fit_encoders(prepared, prepared.train)
    both = encoders.widen(prepared.train, training=True).unionByName(encoders.widen(prepared.test))
    return _finish(prepared, both.select(*KEY, "split", *[F.round(f"{c}_mean", 6).alias(c) for c in columns]), "encoded")


@query(
    _stump_ctes(_TEST_SIDES)
    + f"select {KEYS}, round(p1 + 0.1 * p2, 6) as prediction, round(exp(p1 + 0.1 * p2) - 1, 4) as exp_prediction, "
    "cast(1 as bigint) as version from r2 where held"
)
def bundle_estimates(spark, sf_dir):
    """The two-round program saved, loaded from its folder, and applied to the
    listings of the test side as they come."""
    prepared = _stump_rows(spark, sf_dir)
    path = scratch_path(spark, "bundle")
    version = bundle.save(recipes.fit(prepared), path)
    prepared.release()
    listings = split.with_split(prop_signal(spark, sf_dir), KEY).filter(F.col(split.SPLIT) == "test")
    estimates = bundle.load(spark, path).estimate(listings.drop("price", split.SPLIT))
    return estimates.select(
        *KEY,
        F.round("prediction", 6).alias("prediction"),
        F.round("exp_prediction", 4).alias("exp_prediction"),
        F.lit(version).cast("long").alias("version"),
    )


def _summary_sql() -> str:
    """The report of the stump search: its winner's scores on the test rows."""
    first = (
        "scored as (select y, case when max_iter = 2 then p1 + step_size * p2 else p1 end as p, exp(y) - 1 as price, "
        "exp(case when max_iter = 2 then p1 + step_size * p2 else p1 end) - 1 as ep from r2, best where k = 5 and held), "
        "s as (select count(*) as n, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) as r2_log from scored), "
    )
    removed = "removed as (select f, gain from t1 where k = 5 union all select f, gain from t2, best where k = 5 and max_iter = 2), "
    names = "names as (select * from (values " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(STUMP_FEATURES)) + ") v(f, feature)), "
    ranked = (
        "weights as (select feature, f, coalesce(sum(gain), 0) / (select sum(gain) from removed) as importance "
        "from names left join removed using (f) group by feature, f), "
        "ranked as (select feature, importance, row_number() over (order by importance desc, f) as rank from weights) "
    )
    blocks = [
        ("tuning", 1, "max_depth", "1"),
        ("tuning", 2, "max_iter", "max_iter"),
        ("tuning", 3, "step_size", "step_size"),
        ("tuning", 4, "cv_r2", "mean"),
        ("stability", 1, "cv_r2", "mean"),
        ("stability", 2, "test_r2", "r2_log"),
        ("stability", 3, "gap", "abs(mean - r2_log)"),
    ]
    rows = [
        f"select '{a}' as section, {b} as position, '{c}' as metric, round(cast({d} as double), 6) as value from s, best"
        for a, b, c, d in blocks
    ]
    rows.append("select 'summary', cast(rank as int), feature, round(importance, 6) from ranked where rank <= 3")
    return (
        _stump_ctes(f"{_FOLD_SIDES} union all select 5, split = 'test', * from keyed")
        + ", folded as (select k, max_iter, step_size, y, p1 + case when max_iter = 2 then step_size * p2 else 0 end as p "
        "from r2, (values (1), (2)) n(max_iter), (values (cast(0.05 as double)), (cast(0.1 as double))) s(step_size) "
        "where held and k < 5), per as (select k, max_iter, step_size, 1 - avg((y - p) ** 2) / var_pop(y) as score "
        "from folded group by k, max_iter, step_size), means as (select max_iter, step_size, avg(score) as mean from per "
        "group by max_iter, step_size), best as (select * from means order by mean desc, max_iter, step_size limit 1), "
        + first + removed + names + ranked + " union all ".join(rows)
    )


@query(_summary_sql())
def summary_report_stumps(spark, sf_dir):
    """Tuning, stability and summary blocks of a searched program's report, five
    folds over all rows, checked to the line."""
    rows = prop_signal(spark, sf_dir).select(*KEY, "price", *STUMP_FEATURES)
    lines = report.run(rows, STUMP_RECIPE, row_key=KEY, grid=STUMP_GRID)
    kept = lines.filter("section in ('tuning', 'stability', 'summary')")
    return kept.withColumn("value", F.round("value", 6))


def _first_rounds(spark, sf_dir, depth):
    """The optimized program with two rounds of trees that SQL can state."""
    recipe = recipes.OPTIMIZED_RECIPE.with_(booster=exact_trees.booster(depth))
    return recipes.fit(recipes.prepare(prop_signal(spark, sf_dir), recipe, row_key=KEY))


@query(exact_trees.ctes(1) + f" select {KEYS}, round(prediction, 6) as prediction from boosted where held")
def gbt_first_rounds_optimized(spark, sf_dir):
    """The whole preparation, numeric and nominal features, two rounds of trees
    of one level: every test prediction."""
    fitted = _first_rounds(spark, sf_dir, 1)
    scored = fitted.score(fitted.prepared.test)
    return _finish(fitted.prepared, scored.select(*KEY, F.round("prediction", 6).alias("prediction")), "scores")


@query(
    exact_trees.ctes(2) + f" select {KEYS}, price, round(y, 6) as log_price, round(prediction, 6) as prediction, "
    "round(exp(prediction) - 1, 3) as exp_prediction from boosted where held"
)
def score_batch(spark, sf_dir):
    """Estimates of all test rows on both scales, next to the price: the
    optimized program's preparation, two rounds of trees of two levels."""
    fitted = _first_rounds(spark, sf_dir, 2)
    scored = fitted.score(fitted.prepared.test).select(
        *KEY,
        "price",
        F.round("log_price", 6).alias("log_price"),
        F.round("prediction", 6).alias("prediction"),
        F.round("exp_prediction", 3).alias("exp_prediction"),
    )
    return _finish(fitted.prepared, scored, "scores")


@query(exact_trees.importance_sql(2, report.TOP_FEATURES))
def importance_topk(spark, sf_dir):
    """The fifteen highest importances of the same program, with their
    features."""
    fitted = _first_rounds(spark, sf_dir, 2)
    fitted.prepared.release()
    ranked = report.importance_topk(fitted.importances())
    return ranked.withColumn("importance", F.round("importance", 6))
