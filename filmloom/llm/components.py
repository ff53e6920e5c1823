"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (v, m): large ones hang every larger neighbour on the least of a node's neighbours, small ones the others.

    The least neighbour is an aggregate that is stored and joined back, so a node with most of the links is not
    gathered, and its rows can be split in the join.
    """
    both = links.select("a", "b")
    both = both.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else both
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("of"), F.least("a", "least").alias("m"))
    # only there may one node have most of the rows: a small star groups by the larger end of a link
    least = stored(least, "least") if large else least
    joined = both.join(least, both["a"] == least["of"])
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable), for every node of links (a, b)."""
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        now = stored(_star(_star(now, True), False), "links")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state or not mark[0]:
            break
        state = mark
    return now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
