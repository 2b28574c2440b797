"""JSON records whose shape changed between crawls.

Each source's schema is inferred by itself and the schemas are merged: nested
fields are united, in the order in which they first occur, and a conflict of
types is widened by rule so that every value can still be read:

- integers of any size become long; an integer and a fraction become double
  (exact up to 2**53);
- any other two types, a nested value and a plain one among them, become string,
  and a value is then the JSON text that it was;
- a field that is null everywhere in one source takes the other's type.

All sources are then read in one pass with the merged schema. Records that lack
a field have null there."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from priceloom.sources.readers import read_table

INTEGERS = (ByteType, ShortType, IntegerType, LongType)
FRACTIONS = (FloatType, DoubleType, DecimalType)


def merge_types(a: DataType, b: DataType) -> DataType:
    """The narrowest type by the rules above that holds values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merge_types(a.elementType, b.elementType))
    if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
        return LongType()
    if isinstance(a, INTEGERS + FRACTIONS) and isinstance(b, INTEGERS + FRACTIONS):
        return DoubleType()
    return StringType()


def merge_schemas(a: StructType, b: StructType) -> StructType:
    theirs = {f.name: f.dataType for f in b.fields}
    merged = [StructField(f.name, merge_types(f.dataType, theirs.pop(f.name, f.dataType))) for f in a.fields]
    return StructType(merged + [StructField(name, kind) for name, kind in theirs.items()])


def conflicts(schemas: Sequence[StructType]) -> dict[str, list[str]]:
    """Fields, by dotted path, that do not have one type in all sources that
    have them, and the types they have there."""
    found: dict[str, list[str]] = {}

    def visit(prefix: str, fields: Sequence[StructField]) -> None:
        for field in fields:
            kinds = found.setdefault(prefix + field.name, [])
            struct = isinstance(field.dataType, StructType)
            kind = "struct" if struct else field.dataType.simpleString()
            if kind not in kinds and kind != "void":
                kinds.append(kind)
            if struct:
                visit(f"{prefix}{field.name}.", field.dataType.fields)

    for schema in schemas:
        visit("", schema.fields)
    return {name: kinds for name, kinds in found.items() if len(kinds) > 1}


def json_schemas(spark: SparkSession, paths: Sequence[str], **options: str) -> list[StructType]:
    """One inferred schema per path; a pass over each."""
    return [read_table(spark, path, "json", **options).schema for path in paths]


def _without_void(kind: DataType) -> DataType:
    if isinstance(kind, NullType):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_without_void(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _without_void(f.dataType)) for f in kind.fields])
    return kind


def read_shapes(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame:
    """All records of JSON sources of different shapes under one schema."""
    schemas = json_schemas(spark, paths, **options)
    merged = _without_void(reduce(merge_schemas, schemas))
    return read_table(spark, paths, "json", merged, **options)


def flat(df: DataFrame, separator: str = "_") -> DataFrame:
    """One column per leaf, named by its path; arrays become JSON text, as CSV
    holds no nested values. Two leaves of one name raise."""

    def leaves(prefix: str, at: Column | None, fields: Sequence[StructField]) -> list[tuple[str, Column]]:
        out = []
        for field in fields:
            value = F.col(f"`{field.name}`") if at is None else at[field.name]
            name = prefix + field.name
            if isinstance(field.dataType, StructType):
                out += leaves(name + separator, value, field.dataType.fields)
            else:
                out.append((name, F.to_json(value) if isinstance(field.dataType, ArrayType) else value))
        return out

    found = leaves("", None, df.schema.fields)
    names = [name.lower() for name, _ in found]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"leaves of one name: {twice}; use another separator")
    return df.select(*[value.alias(name) for name, value in found])
