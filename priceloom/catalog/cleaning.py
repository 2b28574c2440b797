"""Log target, null fill, outliers, derived features."""

from pyspark.sql import functions as F

from priceloom.catalog.base import KEY, KEYS, NUMERIC, PROP_CTE, SPLIT_CASE, prop, query
from priceloom.functions import log_target as log_of
from priceloom.operators import clean, features, split
from priceloom.operators.schema import LOG_TARGET

_LOGGED = f"with {PROP_CTE}, logged as (select *, ln(1 + price) as log_price from prop)"
_FILLED = (
    f"with {PROP_CTE}, filled as (select {KEYS}, coalesce(living_area, 0) as living_area, "
    "bedrooms, bathrooms, land_area from prop)"
)
_BOUNDS = (
    "select avg(log_price) - 3 * stddev_samp(log_price) as lower, "
    "avg(log_price) + 3 * stddev_samp(log_price) as upper from logged"
)


def _logged(spark, sf_dir):
    return clean.with_log_target(prop(spark, sf_dir), "price")


def _filled(spark, sf_dir):
    return clean.fill_nulls(prop(spark, sf_dir).select(*KEY, *NUMERIC), NUMERIC)


def _rounded(df, names, digits=6):
    return df.select(*KEY, *[F.round(F.col(c), digits).alias(c) for c in names])


@query(f"{_LOGGED} select {KEYS}, price, round(log_price, 6) as log_price from logged")
def log_target(spark, sf_dir):
    return _logged(spark, sf_dir).select(*KEY, "price", F.round(LOG_TARGET, 6).alias(LOG_TARGET))


@query(f"{_LOGGED} select {KEYS}, round(exp(log_price) - 1, 4) as price from logged")
def expm1_roundtrip(spark, sf_dir):
    logged = prop(spark, sf_dir).withColumn("log_price", log_of("price"))
    return logged.select(*KEY, F.round(F.expm1("log_price"), 4).alias("price"))


@query(
    f"{_LOGGED} select count(*) as n, round(avg(log_price), 6) as mean, "
    "round(stddev_samp(log_price), 6) as stddev from logged"
)
def target_stats(spark, sf_dir):
    stats = clean.target_stats(_logged(spark, sf_dir))
    return stats.select("n", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"))


@query(
    f"with {PROP_CTE} select {KEYS}, coalesce(living_area, 0) as living_area, bedrooms, "
    "coalesce(nullif(bathrooms, 0), 0) as bathrooms, coalesce(nullif(land_area, 5), 0) as land_area from prop"
)
def null_fill(spark, sf_dir):
    """Nulls in a double and in two integer columns; types stay as they are."""
    gaps = prop(spark, sf_dir).selectExpr(
        *KEY, "living_area", "bedrooms", "nullif(bathrooms, 0) as bathrooms", "nullif(land_area, 5) as land_area"
    )
    return clean.fill_nulls(gaps, NUMERIC)


@query(
    f"with {PROP_CTE} select {KEYS}, living_area, bedrooms from prop "
    "where living_area is not null and l_linenumber <> 7"
)
def drop_invalid_rows(spark, sf_dir):
    """Rows with a null area or a NaN bedroom count go."""
    broken = prop(spark, sf_dir).selectExpr(
        *KEY,
        "living_area",
        "case when l_linenumber = 7 then cast('NaN' as double) else bedrooms end as bedrooms",
    )
    return clean.drop_invalid(broken, ["living_area", "bedrooms"])


@query(
    f"{_LOGGED}, bounds as ({_BOUNDS}) select {KEYS}, round(log_price, 6) as log_price "
    "from logged, bounds where log_price >= lower and log_price <= upper"
)
def outlier_filter_3sigma(spark, sf_dir):
    kept = clean.keep_within_sigma(_logged(spark, sf_dir))
    return kept.select(*KEY, F.round(LOG_TARGET, 6).alias(LOG_TARGET))


@query(
    f"{_LOGGED}, bounds as ({_BOUNDS} where {SPLIT_CASE} = 'train') select {KEYS}, round(log_price, 6) as log_price "
    "from logged, bounds where log_price >= lower and log_price <= upper"
)
def outlier_filter_train_stats(spark, sf_dir):
    """Bounds from the training rows only, so test labels stay unseen."""
    logged = _logged(spark, sf_dir)
    train = split.with_split(logged, KEY).filter(F.col(split.SPLIT) == "train")
    kept = clean.keep_within_sigma(logged, fit_on=train)
    return kept.select(*KEY, F.round(LOG_TARGET, 6).alias(LOG_TARGET))


@query(
    f"{_LOGGED}, bounds as ({_BOUNDS}), flags as (select log_price >= lower and log_price <= upper as kept "
    "from logged, bounds) select count(*) as n_rows, count(*) filter (where kept) as n_kept, "
    "count(*) filter (where not kept) as n_removed, count(*) filter (where kept is null) as n_unlabelled from flags"
)
def outlier_count(spark, sf_dir):
    return clean.outlier_counts(_logged(spark, sf_dir))


@query(
    f"{_FILLED} select {KEYS}, round(living_area * living_area, 6) as living_area_squared, "
    "round(bedrooms * bedrooms, 6) as bedrooms_squared, "
    "round(cast(bathrooms as double) * bathrooms, 6) as bathrooms_squared, "
    "round(cast(land_area as double) * land_area, 6) as land_area_squared from filled"
)
def squared_features(spark, sf_dir):
    made = features.squared_columns(NUMERIC)
    return _rounded(features.add_columns(_filled(spark, sf_dir), made), made)


@query(
    f"{_FILLED} select {KEYS}, "
    "round(case when land_area > 0 then living_area / land_area else 0 end, 6) as living_land_ratio, "
    "round(case when bathrooms > 0 then bedrooms / bathrooms else 0 end, 6) as bed_bath_ratio, "
    "round(case when bedrooms > 0 then living_area / bedrooms else 0 end, 6) as area_per_bedroom from filled"
)
def ratio_features(spark, sf_dir):
    made = features.ratio_columns(NUMERIC)
    return _rounded(features.add_columns(_filled(spark, sf_dir), made), made)


@query(
    f"{_FILLED} select {KEYS}, round(living_area * bathrooms, 6) as living_area_x_bathrooms, "
    "round(bedrooms * bathrooms, 6) as bedrooms_x_bathrooms, "
    "round(living_area * land_area, 6) as living_area_x_land_area from filled"
)
def interaction_features(spark, sf_dir):
    made = features.interaction_columns(NUMERIC)
    return _rounded(features.add_columns(_filled(spark, sf_dir), made), made)


_NO_BATHROOMS = {
    "living_area_squared": "living_area * living_area",
    "bedrooms_squared": "bedrooms * bedrooms",
    "land_area_squared": "cast(land_area as double) * land_area",
    "living_land_ratio": "case when land_area > 0 then living_area / land_area else 0 end",
    "area_per_bedroom": "case when bedrooms > 0 then living_area / bedrooms else 0 end",
    "living_area_x_land_area": "living_area * land_area",
}


@query(
    f"{_FILLED} "
    + " union all ".join(
        f"select '{name}' as feature, count({sql}) as n, round(avg({sql}), 6) as mean, "
        f"round(max({sql}), 6) as largest from filled"
        for name, sql in _NO_BATHROOMS.items()
    )
)
def features_missing_inputs(spark, sf_dir):
    """No bathrooms and no total_rooms: only the features that can be made."""
    have = ["living_area", "bedrooms", "land_area"]
    derived, names = features.derive(_filled(spark, sf_dir).drop("bathrooms"), have)
    made = [c for c in names if c not in have]
    stats = derived.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(c).alias("n"),
                F.round(F.avg(c), 6).alias("mean"),
                F.round(F.max(c), 6).alias("largest"),
            ).alias(c)
            for c in made
        ]
    )
    return stats.select(F.inline(F.array(*made)))


_BROKEN = (
    "case l_linenumber when 5 then cast('Infinity' as double) when 6 then cast('NaN' as double) when 7 then null "
    "else price end as price"
)


@query(
    f"with {PROP_CTE}, logged as (select {KEYS}, ln(1 + price) as log_price from prop where l_linenumber < 5), "
    f"bounds as ({_BOUNDS}) select {KEYS}, round(log_price, 6) as log_price from logged, bounds "
    "where log_price >= lower and log_price <= upper"
)
def nonfinite_labels(spark, sf_dir):
    """Infinite, NaN and null prices neither count as labels nor move the bounds."""
    broken = clean.with_log_target(prop(spark, sf_dir).selectExpr(*KEY, _BROKEN), "price")
    return clean.keep_within_sigma(broken).select(*KEY, F.round(LOG_TARGET, 6).alias(LOG_TARGET))
