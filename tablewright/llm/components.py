"""Connected components of a link table by alternating large and small stars, each round on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id it reaches) for the ids of links (a, b); an id without links has no row.

    A star's centre may have any number of links: minima are taken before the shuffle, and only a join on the centre
    follows, which adaptive execution splits. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored(edges, "links"), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = stored(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
