"""Input views and the query registry.

``prop`` shapes ``lineitem`` like a property table; ``prop_signal`` is the same
with a price that the features explain. The column expressions are plain SQL,
used as they are by Spark and by the checking engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its function's name."""

    def register(build: Build) -> Build:
        REGISTRY[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register


KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
KEYS = ", ".join(KEY)

PRICE = "l_extendedprice as price"
SIGNAL_PRICE = (
    "20000 + 900 * l_quantity + 4000 * round(l_tax * 100) + 150 * l_quantity * round(l_tax * 100)"
    " + 2500 * l_linenumber + 50 * (l_suppkey % 100) as price"
)
FEATURE_COLUMNS = (
    "nullif(l_quantity, 1.0) as living_area",
    "cast(l_linenumber as double) as bedrooms",
    "cast(round(l_tax * 100) as int) as bathrooms",
    "cast(round(l_discount * 100) as int) as land_area",
    "l_returnflag as property_type",
    "l_linestatus as city",
)
PROP = (*KEY, PRICE, *FEATURE_COLUMNS)
PROP_SIGNAL = (*KEY, SIGNAL_PRICE, *FEATURE_COLUMNS)
NUMERIC = ("living_area", "bedrooms", "bathrooms", "land_area")
CATEGORICAL = ("property_type", "city")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prop(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*PROP, *extra)


def prop_signal(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*PROP_SIGNAL, *extra)


def cte(name: str, columns: tuple[str, ...], source: str = "lineitem") -> str:
    return f"{name} as (select {', '.join(columns)} from {source})"


PROP_CTE = cte("prop", PROP)
SIGNAL_CTE = cte("prop", PROP_SIGNAL)

HASH = f"md5(concat_ws('|', {', '.join(f'cast({c} as varchar)' for c in KEY)}))"
SPLIT_BUCKET = f"cast(('0x' || substr({HASH}, 1, 8)) as bigint) % 100"
FOLD_BUCKET = f"cast(('0x' || substr({HASH}, 9, 8)) as bigint) % 5"
SPLIT_CASE = f"case when {SPLIT_BUCKET} < 80 then 'train' else 'test' end"
