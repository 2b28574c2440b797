"""Columns and uses the published description names beyond the programs."""

from pyspark.sql import functions as F

from priceloom.catalog.base import KEY, KEYS, PROP_CTE, cte, prop, query, table
from priceloom.catalog.scoring import LINE_CTES, with_line
from priceloom.functions import r2
from priceloom.operators import features, market, metrics
from priceloom.operators.schema import LOG_TARGET

_TOTAL_ROOMS = "cast(l_linenumber + round(l_tax * 100) as int) as total_rooms"


@query(
    f"with {PROP_CTE} select {KEYS}, round(ln(1 + living_area), 6) as log_living_area, "
    "round(ln(1 + land_area), 6) as log_land_area from prop"
)
def doc_log_features(spark, sf_dir):
    made = features.log_columns(["living_area", "land_area"])
    df = features.add_columns(prop(spark, sf_dir), made)
    return df.select(*KEY, *[F.round(c, 6).alias(c) for c in made])


_ROOMS = cte(
    "prop",
    (
        *KEY,
        "l_quantity as living_area",
        "cast(l_linenumber as double) as bedrooms",
        "cast(round(l_tax * 100) as int) as bathrooms",
        _TOTAL_ROOMS,
    ),
)


@query(
    f"with {_ROOMS} select {KEYS}, "
    "round(case when total_rooms > 0 then cast(bathrooms as double) / total_rooms else 0 end, 6) as bath_per_room, "
    "round(bedrooms * bathrooms, 6) as bed_bath, round(bedrooms * living_area, 6) as bed_living, "
    "round(bathrooms * living_area, 6) as bath_living from prop"
)
def doc_room_features(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        *KEY,
        "l_quantity as living_area",
        "cast(l_linenumber as double) as bedrooms",
        "cast(round(l_tax * 100) as int) as bathrooms",
        _TOTAL_ROOMS,
    )
    made = features.room_columns(["living_area", "bedrooms", "bathrooms", "total_rooms"])
    return features.add_columns(df, made).select(*KEY, *[F.round(c, 6).alias(c) for c in made])


_FLAGS = (
    "cast(l_discount > 0.02 as int) as parking",
    "l_tax > 0.04 as garage",
    "cast(nullif(l_returnflag, 'N') = 'R' as int) as pool",
    "l_linestatus = 'O' as terrace",
    "cast(l_quantity >= 40 as int) as sea_view",
    "l_linenumber > 4 as lift",
)
_TIERS = {
    "basic_amenities": ["parking", "garage"],
    "comfort_amenities": ["pool", "terrace"],
    "luxury_amenities": ["sea_view", "lift"],
}


def _flag_sum(flags) -> str:
    return " + ".join(f"coalesce(cast({f} as int), 0)" for f in flags)


@query(
    f"with {cte('prop', (*KEY, *_FLAGS))} select {KEYS}, "
    + ", ".join(f"{_flag_sum(flags)} as {tier}" for tier, flags in _TIERS.items())
    + f", {_flag_sum(f for flags in _TIERS.values() for f in flags)} as amenity_count from prop"
)
def doc_amenity_counts(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(*KEY, *_FLAGS)
    made = features.amenity_columns(_TIERS)
    return features.add_columns(df, made).select(*KEY, *made)


_LINE = LINE_CTES.format(x="living_area")


@query(
    f"{_LINE} select {KEYS}, round((price - exp_prediction) / exp_prediction, 6) as relative_gap, "
    "case when price > exp_prediction then 'overvalued' else 'undervalued' end as verdict from scored "
    "where abs((price - exp_prediction) / exp_prediction) > 0.25"
)
def doc_mispriced(spark, sf_dir):
    found = market.mispriced(with_line(spark, sf_dir), "price", metrics.EXP_PREDICTION, threshold=0.25)
    return found.select(*KEY, F.round("relative_gap", 6).alias("relative_gap"), "verdict")


@query(
    f"{_LINE}, gaps as (select {KEYS}, (price - exp_prediction) / exp_prediction as gap from scored) "
    f"select cast(row_number() over (order by abs(gap) desc, {KEYS}) as int) as rank, {KEYS}, "
    "round(gap, 6) as relative_gap, case when gap > 0 then 'overvalued' else 'undervalued' end as verdict "
    f"from gaps where abs(gap) > 0.25 order by abs(gap) desc, {KEYS} limit 20"
)
def doc_mispriced_top(spark, sf_dir):
    """The twenty listings furthest off their estimate."""
    found = market.most_mispriced(with_line(spark, sf_dir), "price", metrics.EXP_PREDICTION, 20, *KEY)
    return found.select("rank", *KEY, F.round("relative_gap", 6).alias("relative_gap"), "verdict")


@query(
    "select cast(l_suppkey as varchar) as region, l_linestatus as city, count(*) as n, "
    "round(avg(l_extendedprice), 4) as mean_price, round(stddev_samp(l_extendedprice), 4) as stddev_price "
    "from lineitem group by 1, 2"
)
def doc_region_stats(spark, sf_dir):
    df = prop(spark, sf_dir, "cast(l_suppkey as string) as region")
    stats = market.price_by_region(df, "price", "region", "city")
    return stats.withColumns(
        {"mean_price": F.round("mean_price", 4), "stddev_price": F.round("stddev_price", 4)}
    )


def _r2_sql(label, prediction):
    return f"1 - sum(({label} - {prediction}) ** 2) / (var_pop({label}) * count(*))"


_BATH = LINE_CTES.format(x="bath_living")
_SCORES = f"select {_r2_sql('log_price', 'prediction')} as r2 from scored"


@query(
    f"select round(m.r2, 6) as model_score, round(b.r2, 6) as baseline_score, round(m.r2 / b.r2, 6) as relative_score "
    f"from ({_LINE} {_SCORES}) m, ({_BATH} {_SCORES}) b"
)
def doc_relative_score(spark, sf_dir):
    """One model's R2 as a share of another's."""
    rows = [
        with_line(spark, sf_dir, x).agg(F.lit(x).alias("model"), r2(LOG_TARGET, metrics.PREDICTION).alias("r2"))
        for x in ("living_area", "bath_living")
    ]
    share = metrics.relative_score(rows[0].unionByName(rows[1]), "r2", "living_area", "bath_living")
    return share.select(*[F.round(c, 6).alias(c) for c in share.columns])
