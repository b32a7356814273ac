"""Connected components of a table of links, by alternating stars.

Every round points each link at the smallest neighbour of one of its ends (large star, then
small star) until nothing changes; then every node is linked to the smallest node of its
component. Rounds are joins and minima: no neighbour list is gathered, a hot node's rows are
dealt out by Spark's skewed join. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    pointed = both.filter("b > a").join(least, "a")
    return pointed.select(F.least("a", "m").alias("a"), "b").filter("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links (a < b): each larger node's smaller neighbours meet the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    neighbours = links.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("m").alias("a"), "b")
    return neighbours.unionByName(own).filter("a < b").distinct()


def _state(links: DataFrame) -> tuple:
    hashed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), hashed).first())


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of links (a, b)."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    now = materialize(ordered.distinct(), "links")
    before, state = None, _state(now)
    while state != before:
        now = materialize(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
