"""Table sources: CSV, Parquet and JSON over any Hadoop file system URI."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Error classes that mean "nothing to read here", as opposed to a bad or empty
# source, which raises.
MISSING = {"PATH_NOT_FOUND"}
# Java exceptions that mean the file system itself cannot be reached.
UNREACHABLE = (
    "UnknownHostException",
    "ConnectException",
    "NoRouteToHostException",
    "SocketTimeoutException",
    "ConnectTimeoutException",
)


class SourceUnavailable(RuntimeError):
    """None of the candidate paths could be read."""


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read one table. CSV expects a header; without ``schema`` its types are
    inferred, which costs one more pass over the files."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(paths)


def _unavailable(error: Exception) -> bool:
    if isinstance(error, AnalysisException):
        return error.getCondition() in MISSING
    return any(name in str(error) for name in UNREACHABLE)


def read_first(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read the first path that exists and can be reached, in order.

    Only absence moves on to the next path. A file that is there but cannot be
    parsed raises, so a bad primary source is never silently replaced."""
    failures = []
    for path in paths:
        try:
            return read_table(spark, path, fmt, schema, **options)
        except (PySparkException, Py4JJavaError) as error:
            if not _unavailable(error):
                raise
            failures.append(f"{path}: {str(error).splitlines()[0]}")
    raise SourceUnavailable("no readable source among\n  " + "\n  ".join(failures))


def json_to_csv(
    spark: SparkSession,
    json_path: str,
    schema: StructType | str,
    columns: Sequence[str],
    csv_path: str,
) -> None:
    """Flatten JSON records to a CSV table. ``columns`` are SQL expressions, so
    nested fields can be named as ``props.k as k``."""
    records = read_table(spark, json_path, "json", schema)
    records.selectExpr(*columns).write.option("header", True).csv(csv_path)
