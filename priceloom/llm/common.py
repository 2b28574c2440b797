"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.sources.scratch import scratch_path, written

#: A group with at least this share of all rows counts as hot, so there are
#: never more than its inverse of them and they can always be broadcast.
HOT_SHARE = 1 / 1000

__all__ = ["attach", "free_name", "held_out", "scratch_path", "ship", "text_of", "with_row_key", "written"]


_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the library to Python workers that cannot import it, once per
    application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="priceloom-"), "priceloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _shipped[context.applicationId] = path


def text_of(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(id_column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by five. A null id is not
    held out, and not learned from either (``learnable``)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def learnable(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 != 0, F.lit(False))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    return stem if stem.lower() not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def with_row_key(df: DataFrame, name: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Adds a 64-bit key of id and text, equal for repeated rows only."""
    return df.withColumn(name, F.xxhash64(F.col(id_column), F.xxhash64(text_of(text_column))))


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Left join of rows with one row per group, where ``count`` is the number
    of rows of the group. Groups with a thousandth of all rows, of which there
    are a thousand at most, go to the rows by broadcast; the others are joined
    by shuffle, and there no key is hot. ``rows`` should be stored: it is read
    twice. Keys must not be null."""
    least = max(2, int(total * HOT_SHARE))
    hot = groups.filter(F.col(count) >= least)
    cold = groups.filter(F.col(count) < least)
    added = [c for c in groups.columns if c not in keys]
    at_hot = rows.join(F.broadcast(hot), keys, "left")
    joined = at_hot.filter(F.col(count).isNotNull())
    rest = at_hot.filter(F.col(count).isNull()).drop(*added).join(cold, keys, "left")
    return joined.unionByName(rest)
