"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) -> node, component: for each node with a link the least node that it reaches.

    Each round hangs every node's larger neighbours, then its smaller ones, on the least of them, until nothing moves: about
    log2 of a component's diameter rounds. A round is two aggregations and two joins on a node; a hub's links sit on the
    large side of a join, which Spark can split. Rounds end in a reliable checkpoint, so nothing is recomputed if executors
    are lost. Links with a null end or equal ends are left out."""
    edges = links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u < v and u is not null").distinct()
    edges = cut(edges)
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select("v", "m").filter("v != m")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()  # v < u from here
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("x"), F.col("m")), F.struct(F.col("u").alias("x"), F.col("m")))).alias("e"))
        edges = cut(small.select(F.col("e.m").alias("u"), F.col("e.x").alias("v")).filter("u < v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.expr("sum(cast(u as decimal(38,0)))"), F.expr("sum(cast(v as decimal(38,0)))"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    star = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return star.union(star.select("component", "component").distinct())
