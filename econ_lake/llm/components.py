"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.shared import stored


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two rounds gave the same edges: a count and an order-free sum of hashes."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): component is the least node that links reach.

    Each round hangs neighbours onto the least of them; a round's edges are written to the shared folder, and only
    a count and two sums come to the driver.  The joins are on nodes, whose hot ones adaptive execution splits.
    """
    edges = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    mark = _mark(edges)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = stored(small, "stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components need more than {rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
