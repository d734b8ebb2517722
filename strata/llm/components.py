"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); ``root`` is the smallest
    node of its component.

    Each round hangs every node's larger neighbours on its smallest one (large
    star), then its smaller neighbours (small star); the rounds are logarithmic
    in the size of a component.  Only edge rows move, and a node with very many
    edges meets them in joins, which Spark splits."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialise(e, "edges")
    seen = None
    while True:
        mark = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(small, "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
