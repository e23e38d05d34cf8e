"""Connected components of an undirected graph, by Spark joins.

Alternating star contractions: every node hangs its larger neighbours on its
smallest one, then its smaller neighbours likewise, until nothing moves. The
number of rounds grows with the logarithm of the longest path, and no task ever
holds a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.workspace import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    others = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """`node` and `root`, the smallest node it is connected with.

    Nodes without an edge do not appear; loops and repeated edges do no harm.
    """
    big, small = F.greatest(src, dst), F.least(src, dst)
    now = materialize(
        edges.where(F.col(src) != F.col(dst)).select(big.alias("u"), small.alias("v")).distinct(), "edges"
    )

    def sign(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = None
    after = sign(now)
    while after[0] and after != before:
        before = after
        now = materialize(_small_star(_large_star(now)), "edges")
        after = sign(now)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
