"""Connected components of an edge table by alternating large-star and small-star steps.

Only joins and minima are used. Minima are combined before they are shuffled; the join that sends a vertex's minimum back to its edges
is a shuffle join on the vertex, of which adaptive execution splits partitions that are much larger than the median. No vertex's edges are held in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import saved


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another node; root is the smallest node reachable.

    Self loops and repeated edges have no effect; edges with a null end are ignored. Empty edges give no rows.
    """
    now = saved(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    print_now = _fingerprint(now)
    while print_now[0]:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        after = saved(small)
        print_after = _fingerprint(after)
        now, done, print_now = after, print_after == print_now, print_after
        if done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
