"""Connected components of a link table, by alternating large and small stars.

Each round rewires the links towards the smallest node seen, first from every
node to its larger neighbours, then to its smaller ones.  The rounds end when
the links no longer change, which takes a number of rounds that grows with the
logarithm of the longest chain.  Every round's links are written to the shared
folder; nothing but two sums reaches the driver.  The minimum of a node's
neighbours is taken by a grouped aggregate (combined before the shuffle) and
joined back, so a node with very many links is no single task's list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import saved


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(u, v)`` (bigint, no nulls):
    ``root`` is the smallest node that can be reached.  Links of a node to
    itself count for nothing; repeated and reversed links are one."""
    links = saved(links.where("u <> v")
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        links = saved(_small_star(_large_star(links)), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """``u`` is the larger end.  Every larger neighbour of a node is linked to
    the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least
    of its smaller neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()
