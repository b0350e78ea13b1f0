"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (partial aggregation) and joins on node keys, so no
neighbourhood is gathered; AQE splits a hot node's side of a join. Each round is written to
the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.
    Edges with a null end and self edges give nothing; repeated edges count once."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        big = _large_star(e)
        new = stored(_small_star(big), "edges")
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_stored(e)
        e = new
        if tuple(now) == before or now[0] == 0:
            break
        before = tuple(now)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    up = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.filter("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    # every edge of e goes from its larger end u to a smaller v
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    down = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
