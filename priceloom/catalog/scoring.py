"""Scores on a closed-form prediction: a least-squares line on one feature."""

from pyspark.sql import functions as F

from priceloom.catalog.base import CATEGORICAL, HASH, KEY, KEYS, NUMERIC, SIGNAL_CTE, prop, prop_signal, query
from priceloom.operators import clean, metrics, permutation
from priceloom.operators.ranking import top_k

LINE_CTES = (
    f"with {SIGNAL_CTE}, base as (select {KEYS}, price, ln(1 + price) as log_price, "
    "coalesce(living_area, 0) as living_area, coalesce(living_area, 0) * bathrooms as bath_living from prop), "
    "line as (select regr_slope(log_price, {x}) as slope, regr_intercept(log_price, {x}) as intercept from base), "
    "scored as (select base.*, intercept + slope * {x} as prediction, "
    "exp(intercept + slope * {x}) - 1 as exp_prediction from base, line)"
)


def score_sql(label: str, prediction: str) -> str:
    return (
        f"count(*) as n, round(1 - sum(({label} - {prediction}) ** 2) / (var_pop({label}) * count(*)), 6) as r2, "
        f"round(sqrt(avg(({label} - {prediction}) ** 2)), 4) as rmse, round(avg(abs({label} - {prediction})), 4) as mae"
    )


def with_line(spark, sf_dir, x="living_area"):
    """prop_signal with ``prediction`` from a line of log_price on ``x``."""
    df = clean.fill_nulls(prop_signal(spark, sf_dir), ["living_area"])
    df = clean.with_log_target(df, "price").withColumn("bath_living", F.col("living_area") * F.col("bathrooms"))
    slope = df.agg(F.regr_slope("log_price", x)).scalar()
    intercept = df.agg(F.regr_intercept("log_price", x)).scalar()
    return metrics.with_exp_prediction(df.withColumn("prediction", intercept + slope * F.col(x)))


def rounded_scores(df):
    return df.withColumns({"r2": F.round("r2", 6), "rmse": F.round("rmse", 4), "mae": F.round("mae", 4)})


_LINE = LINE_CTES.format(x="living_area")


@query(f"{_LINE} select {score_sql('log_price', 'prediction')} from scored")
def regression_metrics(spark, sf_dir):
    return rounded_scores(metrics.regression_metrics(with_line(spark, sf_dir)))


@query(f"{_LINE} select {score_sql('price', 'exp_prediction')} from scored")
def regression_metrics_original(spark, sf_dir):
    scores = metrics.regression_metrics(with_line(spark, sf_dir), "price", metrics.EXP_PREDICTION)
    return rounded_scores(scores)


_FEATURES = len(NUMERIC) + len(CATEGORICAL)


@query(
    f"{_LINE}, s as (select count(*) as n, 1 - sum((log_price - prediction) ** 2) / (var_pop(log_price) * count(*)) "
    f"as r2 from scored) select n, round(r2, 6) as r2, cast({_FEATURES} as bigint) as feature_count, "
    f"round(1 - (1 - r2) * (n - 1) / (n - {_FEATURES} - 1), 6) as adjusted_r2 from s"
)
def adjusted_r2(spark, sf_dir):
    scores = metrics.with_adjusted_r2(metrics.regression_metrics(with_line(spark, sf_dir)), _FEATURES)
    return scores.select(
        "n", F.round("r2", 6).alias("r2"), "feature_count", F.round("adjusted_r2", 6).alias("adjusted_r2")
    )


@query(
    f"select cast(row_number() over (order by l_extendedprice desc, {KEYS}) as int) as rank, {KEYS}, "
    f"l_extendedprice as price from lineitem order by l_extendedprice desc, {KEYS} limit 15"
)
def topk_generic(spark, sf_dir):
    ranked = top_k(prop(spark, sf_dir).select(*KEY, "price"), 15, F.desc("price"), *[F.asc(c) for c in KEY])
    return ranked.select("rank", *KEY, "price")


_DEALT = ("living_area", "bathrooms", "land_area", "property_type")
#: Estimates of a closed form, so that every variant's loss can be stated.
_CLOSED_FORM = (
    "ln(20000 + 900 * coalesce(living_area, 5) + 4000 * bathrooms + 150 * coalesce(living_area, 5) * bathrooms "
    "+ case when property_type = 'R' then 500 else 0 end)"
)


def _dealt_sql() -> str:
    line = f"over (partition by block order by digest, {', '.join(f'{c} nulls first' for c in _DEALT)}, y nulls first"
    following = ", ".join(
        f"case when lead(1) {line}) is null then first_value({c}) {line} rows between unbounded preceding and unbounded following) "
        f"else lead({c}) {line}) end as next_{c}"
        for c in _DEALT
    )
    variants = " union all ".join(
        f"select {i} as which, y, " + ", ".join(f"next_{c} as {c}" if i == j else c for j, c in enumerate(_DEALT)) + " from paired"
        for i in range(-1, len(_DEALT))
    )
    return (
        f"with {SIGNAL_CTE}, placed as (select {', '.join(_DEALT)}, ln(1 + price) as y, {HASH} as digest, "
        f"cast(('0x' || substr({HASH}, 17, 8)) as bigint) % (select greatest(1, count(*) // 10000) from lineitem) as block from prop), "
        f"paired as (select y, {', '.join(_DEALT)}, {following} from placed), variants as ({variants}), "
        f"losses as (select which, count(*) as n, avg((y - {_CLOSED_FORM}) ** 2) as loss from variants group by which) "
        "select cast(which as int) as feature_index, "
        + "case which " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(_DEALT)) + " end as feature, n, "
        "round(loss, 8) as loss, round(base, 8) as base_loss, round(loss - base, 8) as importance "
        "from losses, (select loss as base from losses where which = -1) where which >= 0"
    )


@query(_dealt_sql())
def permutation_importance_rows(spark, sf_dir):
    """What the error of a closed form grows by when a feature is dealt to other
    rows; land_area, which the form does not use, grows it by nothing."""
    rows = clean.with_log_target(prop_signal(spark, sf_dir), "price")
    losses = permutation.permutation_importance(
        rows, KEY, _DEALT, "log_price", lambda variants: variants.withColumn("prediction", F.expr(_CLOSED_FORM))
    )
    return losses.withColumns({c: F.round(c, 8) for c in ("loss", "base_loss", "importance")})
