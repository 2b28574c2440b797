"""Connected components by alternating star contraction.

Each round folds up the least neighbour of every node before it moves and joins it
back to the edges, the centres of large stars by broadcast, so that no star lands in
one task. The edges are written to the shared folder in between: lineage stays
short and a lost executor costs one round. Nothing but one count and one checksum
per round reaches the driver. Rounds go on until the edges no longer change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import attach
from priceloom.sources.scratch import written


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """Adds m, the least neighbour v of u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
    return attach(edges, least, ["u"], "degree", total).drop("degree")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _with_least(both, 2 * total).withColumn("m", F.least("m", "u"))
    return near.filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    near = _with_least(edges, total)
    moved = near.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.filter("v = m").select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (u, v); the root is the
    smallest node of the component. Loops and repeated edges do no harm; an
    empty list gives no rows."""
    now = written(edges.filter("u <> v").select("u", "v"), "edges")
    total, before = now.count(), None
    while True:
        large = _large_star(now, total)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        now = written(_small_star(written(down, "edges"), total), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        total, before = seen[0], tuple(seen)
