"""Connected components by alternating large-star and small-star steps, all as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(id, component) for each id that an edge (u, v) names; component is its smallest reachable id.

    Each round is two aggregations by vertex and two joins back; rounds follow the logarithm of the longest
    chain. Each round's edges are written to the shared folder, so a lost executor costs a round at most.
    Hot vertices: the minimum is combined before the shuffle and the joins are of written or exchanged
    tables, which adaptive execution splits.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(most):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        large = cut(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        old, e = e, cut(small, "small")
        discard(old, large)
        now = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40)))).first()
        if mark == now:
            break
        mark = now
    else:
        raise RuntimeError(f"components: no fixed point after {most} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
