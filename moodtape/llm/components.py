"""Connected components of links, by alternating large-star and small-star rounds.

Every round is two joins of the links with one row per node, so a node with very many links is a hot join key that
Spark can split, never a group in one task.  Links are written to the shared folder each round.  Nothing but a count
and a checksum reaches the driver.  The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtape.llm.common import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (low, high) to links towards the smallest neighbour."""
    if large:
        both = links.unionByName(links.select(F.col("high").alias("low"), F.col("low").alias("high")))
        around = both.select(F.col("low").alias("node"), F.col("high").alias("near"))
    else:
        around = links.select(F.col("high").alias("node"), F.col("low").alias("near"))
    least = around.groupBy("node").agg(F.min("near").alias("least")).select("node", F.least("node", "least").alias("least"))
    joined = around.join(least, "node")
    if large:
        out = joined.where("near > node").select(F.col("least").alias("low"), F.col("near").alias("high"))
    else:
        own = least.select(F.col("least").alias("low"), F.col("node").alias("high"))
        out = joined.select(F.col("least").alias("low"), F.col("near").alias("high")).unionByName(own)
    return out.where("low < high").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links`` (low, high); the component is its smallest node."""
    links = staged(links.where("low < high").select("low", "high").distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        links = staged(_star(_star(links, True), False), "links")
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
