"""Ordering: bounded top-k reports and an unbounded distributed ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.sources.scratch import checkpointed

# Layout of monotonically_increasing_id: partition in the upper bits, row
# number within the partition in the lower 33.
_ROW_BITS = 33


def top_k(df: DataFrame, k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows with a 1-based rank. The limit runs per partition
    first (TakeOrderedAndProject), so the window only ever sees k rows."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def global_rank(df: DataFrame, *order: Column, rank: str = "rank") -> DataFrame:
    """0-based position of every row in the total order, for any row count.

    A range sort spreads the rows; the checkpoint pins that layout; the number
    of rows in the partitions before gives each partition its offset. Only the
    offsets (one row per partition) pass through one task."""
    position = F.monotonically_increasing_id()
    placed = checkpointed(df.orderBy(*order).withColumn("_at", position))
    part = F.shiftrightunsigned("_at", _ROW_BITS)
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, row + F.col("_offset"))
        .drop("_at", "_part", "_offset")
    )
