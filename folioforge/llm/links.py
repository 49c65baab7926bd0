"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

_SIDE = 0x5555555555555555


def _with_least(pairs: DataFrame) -> DataFrame:
    """Joins each pair (u, v) with the least of u and its neighbours. Joined by another expression than it was summed by, each side
    gets an exchange of its own, which Spark may split where a node has very many."""
    side = F.col("u").bitwiseXOR(F.lit(_SIDE))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(side.alias("w"), F.least("u", "m").alias("m"))
    return pairs.withColumn("w", side).join(least, "w").drop("w")


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of an edge (u, v), neither null: root is the least node reachable. No edges give no rows.

    Each round rewrites the edges so that nodes hang on smaller ones and writes them to the shared
    folder; a logarithmic number of rounds leaves stars. Only counts reach the driver. Edges never
    outnumber those of the round before.
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = _with_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = materialize(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
