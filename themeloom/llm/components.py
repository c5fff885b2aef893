"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.session import materialize


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root`` of every node of ``a, b``; the root is the smallest node that can be reached.

    Only minima are aggregated, so no node's neighbours are ever gathered; the join of a node with many
    neighbours is split by adaptive execution.
    """
    now = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
    )
    mark = None
    for _ in range(rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                now.select("lo", "lo")
            ).distinct()
        mark = seen
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = materialize(large, "large-star")
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").filter("lo <> m").select("lo", "m").union(lowest.select("hi", "m"))
        now = materialize(small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct(), "small-star")
    raise RuntimeError("components did not settle")
