"""Connected components of a graph given as a table of links.

Alternates two steps until nothing changes: every node hands its larger neighbours to the smallest node
it knows, then every node hands its smaller neighbours to the smallest.  Links become stars around the
smallest node of each component.  Minima are aggregated before the shuffle and joined back, so a node with
very many links is never gathered; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    joined = both.join(least, F.col("a") == F.col("node")).withColumn("least", F.least("least", "node"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    joined = down.join(least, F.col("a") == F.col("node"))
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; ``links`` has columns a and b, root is the smallest node."""
    links = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(links)
    while state[0]:
        links = materialise(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
