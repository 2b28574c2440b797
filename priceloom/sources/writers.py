"""Sinks: tables in any Spark file format, and fitted pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
