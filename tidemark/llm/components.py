"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node reachable from each node that has a link: (node, root).

    Alternates two steps until the links stop changing: every node hands its
    larger neighbours the smallest one it knows, then its smaller ones. Links
    end up as a star around each root; the number of rounds grows with the
    logarithm of the longest chain. A node with very many links is one minimum
    per task in the aggregate, and its links meet that minimum in a join whose
    large partitions can be split. Links and repeated rows between a node and
    itself are harmless; rows with a null end take no part.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    stars = cut_lineage(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = cut_lineage(large.distinct())
        small = _least(large)
        linked = small.select("v", "m").unionByName(small.select(F.col("u").alias("v"), "m"))
        stars = cut_lineage(linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        now = _mark(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _least(links: DataFrame) -> DataFrame:
    """Add to every link the smallest ``v`` of its ``u``."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u")


def _mark(links: DataFrame) -> tuple:
    """Number and hash sum of the links; equal marks mean nothing has changed."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(hashed)).first())
