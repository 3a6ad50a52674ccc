"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step.  Large star: every larger neighbour of ``u`` moves to the least of ``u`` and its
    neighbours.  Small star: every smaller neighbour of ``u``, and ``u``, move to the least."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = sides.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for each node of an edge; ``root`` is the least node of its component.

    Edges are undirected; loops and nulls are dropped, repeated edges count once.  Nodes outside
    any edge have no row.  Every round is written to the shared folder, so the plan stays short
    and survives lost executors; only two numbers per round reach the driver."""
    clean = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = stored(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")
        ).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        now = stored(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
