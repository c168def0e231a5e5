"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c) for every vertex of an edge, where c is the smallest vertex it is connected with.

    Each half-step joins the edges with the smallest neighbour of a vertex. The minima
    are partially aggregated and written first, so that the join sits directly on two
    exchanges and Spark splits the tasks of a hub. Loops and null ends are ignored;
    repeated edges count once; no edges give an empty result.
    """
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    e = materialize(ends.distinct(), "edges")
    while e.limit(1).count():
        old = e
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        minima = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "minima")
        least = minima.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "edges")
        discard(old, minima)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        done = not small.limit(1).count()
        discard(large, least)
        # done when every vertex has one parent and no parent has a parent
        if done and not e.select(F.col("v").alias("u")).distinct().join(e, "u", "left_semi").limit(1).count():
            break
    roots = e.select("v", F.col("v").alias("c")).distinct()
    return e.select(F.col("u").alias("v"), F.col("v").alias("c")).union(roots)
