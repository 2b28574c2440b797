"""Category indexes and the assembled feature vector."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from priceloom.catalog.base import CATEGORICAL, KEY, KEYS, NUMERIC, PROP, PROP_CTE, SPLIT_CASE, cte, prop, query
from priceloom.operators import clean, encode, split
from priceloom.plans.boosting import FEATURES, assembler

_CONDITION = "nullif(l_returnflag, 'A') as condition"
_STREET = "concat('street-', l_orderkey) as street"
_INDEXED = (*CATEGORICAL, "condition")


def _index_sql(column: str, source: str = "prop", where: str = "true") -> str:
    """(label, idx): most frequent first, equal counts in label order."""
    return (
        f"select {column} as label, row_number() over (order by count(*) desc, {column}) - 1 as idx "
        f"from {source} where {column} is not null and {where} group by {column}"
    )


def _code(column: str) -> str:
    return f"cast(coalesce({column}_idx.idx, (select count(*) from {column}_idx)) as bigint) as {column}_indexed"


def _indexed_sql(columns, view: str, where: str = "true") -> str:
    ctes = ", ".join(f"{c}_idx as ({_index_sql(c, where=where)})" for c in columns)
    joins = " ".join(f"left join {c}_idx on {c}_idx.label = prop.{c}" for c in columns)
    return f"with {view}, {ctes} select {KEYS}, {', '.join(map(_code, columns))} from prop {joins}"


def _codes(df, columns):
    return df.select(*KEY, *[F.col(f"{c}_indexed").cast("bigint").alias(f"{c}_indexed") for c in columns])


@query(_indexed_sql(_INDEXED, cte("prop", (*PROP, _CONDITION))))
def category_index(spark, sf_dir):
    """Bounded label sets, one of them with nulls, counted in one pass."""
    df = prop(spark, sf_dir, _CONDITION)
    return _codes(encode.index_categories(df, encode.fit_indexers(df, _INDEXED)), _INDEXED)


@query(_indexed_sql(("street",), cte("prop", (*PROP, _STREET))))
def category_index_wide(spark, sf_dir):
    """As many labels as orders: numbered and looked up by distributed steps."""
    df = prop(spark, sf_dir, _STREET).select(*KEY, "street")
    return _codes(encode.apply_index(df, encode.frequency_index(df, "street"), "street"), ["street"])


@query(_indexed_sql(("street",), cte("prop", (*PROP, _STREET)), where=f"{SPLIT_CASE} = 'train'"))
def category_index_unseen(spark, sf_dir):
    """Fitted on training rows only; labels seen only in test share one index."""
    df = split.with_split(prop(spark, sf_dir, _STREET), KEY).select(*KEY, "street", split.SPLIT)
    train = df.filter(F.col(split.SPLIT) == "train")
    return _codes(encode.apply_index(df, encode.frequency_index(train, "street"), "street"), ["street"])


_VECTOR = (
    f"with {PROP_CTE}, "
    + ", ".join(f"{c}_idx as ({_index_sql(c)})" for c in CATEGORICAL)
    + f", wide as (select {KEYS}, [living_area, bedrooms, bathrooms, land_area, "
    + ", ".join(f"{c}_idx.idx" for c in CATEGORICAL)
    + "] as features from prop "
    + " ".join(f"join {c}_idx on {c}_idx.label = prop.{c}" for c in CATEGORICAL)
    + " where living_area is not null)"
    + f" select {KEYS}, cast(i as int) as feature_index, cast(features[i + 1] as double) as value "
    "from wide, range(6) r(i)"
)


@query(_VECTOR)
def feature_vector(spark, sf_dir):
    """Numeric features, then indexed categories; rows with nulls skipped."""
    df = prop(spark, sf_dir)
    indexed = encode.index_categories(df, encode.fit_indexers(df, CATEGORICAL))
    inputs = [*NUMERIC, *[encode.indexed_name(c) for c in CATEGORICAL]]
    vectors = assembler(inputs).transform(indexed)
    return vectors.select(*KEY, F.posexplode(vector_to_array(FEATURES)).alias("feature_index", "value"))


_ENCODED = (
    f"with {PROP_CTE}, keyed as (select {KEYS}, ln(1 + price) as y, cast(l_suppkey as varchar) as neighborhood, "
    f"{SPLIT_CASE} as split from prop), overall as (select avg(y) as mean from keyed where split = 'train'), "
    "means as (select neighborhood, (sum(y) + 10 * any_value(mean)) / (count(*) + 10) as encoded from keyed, overall "
    "where split = 'train' group by neighborhood) "
)


@query(
    f"{_ENCODED} select {KEYS}, round(coalesce(encoded, mean), 6) as neighborhood_encoded "
    "from keyed cross join overall left join means using (neighborhood)"
)
def doc_target_encoding(spark, sf_dir):
    """Smoothed target mean per neighbourhood, fitted on training rows."""
    df = prop(spark, sf_dir, "cast(l_suppkey as string) as neighborhood")
    df = split.with_split(clean.with_log_target(df, "price"), KEY)
    df = df.select(*KEY, "neighborhood", "log_price", split.SPLIT)
    train = df.filter(F.col(split.SPLIT) == "train")
    means = encode.target_means(train, "neighborhood", "log_price")
    encoded = encode.apply_target_means(df, means, "neighborhood", "neighborhood_encoded")
    return encoded.select(*KEY, F.round("neighborhood_encoded", 6).alias("neighborhood_encoded"))
