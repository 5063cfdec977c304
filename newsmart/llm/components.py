"""Connected components of a link table, by alternating large and small stars.

Each round rewires every link towards the smallest node known, so long chains
halve and hubs never grow beyond one link per member. Only DataFrame joins and
pre-aggregated minima run; nothing is collected but a row count and a checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.common import drop_stored, store


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to that node's smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)``: undirected links between orderable nodes, in any direction,
    repeats allowed. Returns ``(node, root)`` with the smallest node reachable for
    every node that is not itself a smallest one. Self-links and nulls are ignored;
    an empty table gives an empty table."""
    spark = links.sparkSession
    now = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links"
    )
    seen = None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign[0] == 0 or sign == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, before = sign, now
        now = store(_small_star(_large_star(now)), "links")
        drop_stored(spark, before)
