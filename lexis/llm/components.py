"""Connected components of a link table, without any table on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.session import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node that has a link to another one, where
    ``component`` is the smallest node reachable.

    Alternates large-star and small-star steps: each node points its larger
    (then its smaller) neighbours at the smallest node it sees.  The links
    shrink to stars in a number of rounds that grows with the logarithm of the
    largest component.  Minima are pre-aggregated before each shuffle, and a
    node with very many links only ever is a join key with a one-row side, so
    adaptive execution can split it.  Every round is a written table."""
    pair = lambda x, y: (F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"))
    edges = links.select(*pair(F.col(a), F.col(b))).where("lo < hi").distinct()
    edges = written(edges, "links")

    def facts(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    before = facts(edges)
    while before[0]:
        # large star: (u, v) both ways, v > u moves to the smallest of u's neighbourhood
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(*pair(F.col("v"), F.col("m")))
                 .where("lo < hi").distinct())
        # small star: a node's smaller neighbours and itself move to the smallest of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").select(*pair(F.col("lo"), F.col("m")))
                 .union(low.select(*pair(F.col("hi"), F.col("m")))).where("lo < hi").distinct())
        edges = written(small, "links")
        after = facts(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
