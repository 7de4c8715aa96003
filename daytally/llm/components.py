"""Connected components of a link table, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.scratch import cut


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour (or itself)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); the component is its least node.

    Alternates large and small stars until nothing changes.  Both keep the components and
    never hold more links than they are given; each round is written to the shared folder, and a
    node with many links is joined, not gathered.
    """
    links = cut(links.select("a", "b").filter("a <> b").distinct(), "links")
    sign = _sign(links)
    while sign[0]:
        links = cut(_small_star(_large_star(links)), "links")
        now = _sign(links)
        if now == sign:
            break
        sign = now
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())


def _sign(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
