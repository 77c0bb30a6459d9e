"""Connected components of a link table: smallest reachable id for every linked node.

Alternating large-star and small-star rounds: each round points every node at the
smallest node it knows, with joins and partial aggregations only, and ends when a round
changes nothing. Links never reach the driver; each round's links are stored in the shared
checkpoint folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Links (a > b): each node tells its larger neighbours its smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node tells its smaller neighbours (and itself) the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = (links.join(least, "a").filter(F.col("b") != F.col("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b), nodes of no link excluded."""
    now = stored(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        then = stored(_small_star(_large_star(now)))
        # finished when every node points at one other that points nowhere
        tails = then.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        heads = then.select(F.col("b").alias("a")).distinct()
        open_ = tails.filter(F.col("n") > 1).select("a").unionByName(
            tails.select("a").join(heads, "a", "left_semi"))
        now = then
        if open_.isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
