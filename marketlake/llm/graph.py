"""Connected components over an edge table, without collecting links.

Alternates two star steps until nothing changes: every node hands its larger
neighbours to its smallest one, then its smaller neighbours. Each step is a
pre-aggregated minimum per node and an equi-join, whose hot nodes adaptive
execution splits. Each round is written with ``checkpoint()`` to the shared
folder, so a lost executor costs a re-read and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u and its v's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b; no nulls).

    root is the smallest node of the component. Loops and repeated or reversed
    edges are allowed; an empty table gives an empty result.
    """
    cur = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
           .distinct().checkpoint())
    mark = _mark(cur)
    while mark[0]:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = (_to_smallest(both).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        small = _to_smallest(large)
        cur = (small.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
               .where("a <> b").distinct().checkpoint())
        now = _mark(cur)
        if now == mark:
            break
        mark = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
