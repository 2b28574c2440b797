"""Schema and shape queries."""

from pyspark.sql import functions as F

from priceloom.catalog.base import KEY, PROP, PROP_CTE, cte, prop, query, table
from priceloom.operators import clean
from priceloom.operators.schema import LOG_TARGET, column_profile, plan_columns, resolve_target, table_shape

_EXTRA = (
    "l_returnflag = 'R' as is_returned",
    "l_shipdate as listed_at",
    "case when l_discount = 0 then cast('NaN' as double) else l_discount end as rebate",
)
_ROLES = (
    ("l_orderkey", "long", "row_key"),
    ("l_linenumber", "integer", "row_key"),
    ("l_partkey", "long", "row_key"),
    ("l_suppkey", "long", "row_key"),
    ("price", "double", "target"),
    ("living_area", "double", "numeric"),
    ("bedrooms", "double", "numeric"),
    ("bathrooms", "integer", "numeric"),
    ("land_area", "integer", "numeric"),
    ("property_type", "string", "categorical"),
    ("city", "string", "categorical"),
    ("is_returned", "boolean", "numeric"),
    ("listed_at", "timestamp_ntz", "ignored"),
    ("rebate", "double", "numeric"),
)


def _profile_sql() -> str:
    rows = []
    for position, (name, kind, role) in enumerate(_ROLES, start=1):
        nans = f"count(*) filter (where isnan({name}))" if kind == "double" else "0"
        rows.append(
            f"select {position} as position, '{name}' as name, '{kind}' as type, '{role}' as role, "
            f"count(*) filter (where {name} is null) as nulls, cast({nans} as bigint) as nans from prop"
        )
    return f"with {cte('prop', (*PROP, *_EXTRA))} " + " union all ".join(rows)


@query(f"with {PROP_CTE} select count(*) as n_rows, cast({len(PROP)} as bigint) as n_columns from prop")
def frame_shape(spark, sf_dir):
    return table_shape(prop(spark, sf_dir))


@query(_profile_sql())
def schema_profile(spark, sf_dir):
    df = prop(spark, sf_dir, *_EXTRA)
    return column_profile(df, plan_columns(df.schema, row_key=KEY))


@query(
    "select 'o_totalprice' as target, count(*) as n, round(avg(ln(1 + o_totalprice)), 6) as mean, "
    "round(stddev_samp(ln(1 + o_totalprice)), 6) as stddev from orders"
)
def target_fallback(spark, sf_dir):
    """No ``price`` column: the first integer, double or long one is used."""
    df = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_totalprice", "o_custkey")
    target = resolve_target(df.schema)
    stats = clean.target_stats(clean.with_log_target(df, target), LOG_TARGET)
    return stats.select(
        F.lit(target).alias("target"),
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
    )
