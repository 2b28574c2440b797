"""Damaged rows go to a side table instead of becoming nulls or ending a job.

A row is damaged if its text does not fit the schema: a value that is no number,
too few or too many fields, broken JSON. Whole rows are parsed whatever columns
a query asks for, so what counts as damaged does not depend on the query. The
side table is written once, in one pass over the source, with the file and the
text of each damaged row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from priceloom.sources.readers import read_table


@dataclass(frozen=True)
class Quarantined:
    """``rows`` that fit the schema, ``damaged`` (file, record) as stored at
    ``path``, and how many."""

    rows: DataFrame
    damaged: DataFrame
    n_damaged: int
    path: str


def read_quarantined(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    quarantine: str,
    fmt: str = "csv",
    **options: str,
) -> Quarantined:
    """Read CSV or JSON with an explicit schema; damaged rows are written to
    ``quarantine``, which must not exist yet. An empty source has none."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"only text formats have damaged rows, not {fmt}")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    record = "damaged_record"
    while record in schema.names:
        record += "_"
    whole = StructType([*schema.fields]).add(record, StringType())
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": record} | options
    # the hash, always in its range, makes every query parse all columns
    parsed = read_table(spark, path, fmt, whole, **settings).filter(F.hash(*schema.names) <= 2**31 - 1)
    damaged = parsed.filter(F.col(record).isNotNull())
    damaged.select(F.input_file_name().alias("file"), F.col(record).alias("record")).write.parquet(quarantine)
    side = spark.read.schema("file string, record string").parquet(quarantine)
    return Quarantined(parsed.filter(F.col(record).isNull()).drop(record), side, side.count(), quarantine)
