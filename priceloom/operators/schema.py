"""Column planning from the schema alone: nothing here reads a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The target name, the log target's name, and the types that may
# stand in for a missing target.
TARGET = "price"
LOG_TARGET = "log_price"
TARGET_TYPES = ("integer", "double", "long")

NUMERIC_TYPES = ("byte", "short", "integer", "long", "float", "double", "decimal")


@dataclass(frozen=True)
class ColumnPlan:
    """What each input column is used for, in schema order."""

    target: str
    numeric: tuple[str, ...]
    boolean: tuple[str, ...]
    categorical: tuple[str, ...]
    ignored: tuple[str, ...]
    row_key: tuple[str, ...] = ()

    def role(self, name: str) -> str:
        if name == self.target:
            return "target"
        if name in self.row_key:
            return "row_key"
        if name in self.categorical:
            return "categorical"
        return "numeric" if name in self.numeric else "ignored"


def resolve_target(schema: StructType, target: str = TARGET) -> str:
    """``target`` when present (case-sensitive), else the first integer, double
    or long column."""
    if target in schema.names:
        return target
    for field in schema.fields:
        if field.dataType.typeName() in TARGET_TYPES:
            return field.name
    raise ValueError(f"no column {target!r} and no integer, double or long column to use instead")


def plan_columns(
    schema: StructType,
    target: str = TARGET,
    row_key: Sequence[str] = (),
) -> ColumnPlan:
    """Split the columns into target, numeric, categorical and ignored.

    Booleans count as numeric and are cast to 0/1 before use. Dates, timestamps
    and nested types cannot be features and are reported as ignored. Row key
    columns identify rows and are no features; an input column that carries the
    log target's name is overwritten and is no feature either."""
    chosen = resolve_target(schema, target)
    missing = [c for c in row_key if c not in schema.names]
    if missing:
        raise ValueError(f"row key columns not in the table: {missing}")
    numeric, boolean, categorical, ignored = [], [], [], []
    for field in schema.fields:
        kind = field.dataType.typeName()
        if field.name in (chosen, LOG_TARGET) or field.name in row_key:
            continue
        if kind == "string":
            categorical.append(field.name)
        elif kind == "boolean":
            boolean.append(field.name)
            numeric.append(field.name)
        elif kind in NUMERIC_TYPES:
            numeric.append(field.name)
        else:
            ignored.append(field.name)
    return ColumnPlan(
        target=chosen,
        numeric=tuple(numeric),
        boolean=tuple(boolean),
        categorical=tuple(categorical),
        ignored=tuple(ignored),
        row_key=tuple(row_key),
    )


def table_shape(df: DataFrame) -> DataFrame:
    """One row: (n_rows, n_columns)."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def column_profile(df: DataFrame, plan: ColumnPlan) -> DataFrame:
    """One row per column: position, type, role, and how many values are null
    or NaN. All counts come from one aggregate pass, then one row is unpivoted
    into as many rows as there are columns."""

    def count_if(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    counts, entries = [], []
    for position, field in enumerate(df.schema.fields, start=1):
        kind = field.dataType.typeName()
        counts.append(count_if(F.col(field.name).isNull(), f"null_{position}"))
        nans = F.lit(0).cast("bigint")
        if kind in ("float", "double"):
            counts.append(count_if(F.isnan(field.name), f"nan_{position}"))
            nans = F.col(f"nan_{position}")
        entries.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("name"),
                F.lit(kind).alias("type"),
                F.lit(plan.role(field.name)).alias("role"),
                F.col(f"null_{position}").alias("nulls"),
                nans.alias("nans"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*entries)))
