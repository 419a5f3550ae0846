"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.session import settle


def _stars(links: DataFrame) -> bool:
    """True if every larger end has one link, and no smaller end is a larger end too: components are then done."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    roles = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return roles.where("down > 1 OR down + up > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable.

    Each round writes its links to the shared folder, so lineage stays short. Minima are settled before they
    are joined: both join sides are then plain shuffles, which Spark splits where a hub holds many links. A round
    never makes more links than it was given. Links of a node to itself and null ends are ignored.
    """
    e = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _stars(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = settle(both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")), "large")
        low = settle(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")
        )
        e = settle(small.select("x.a", "x.b").where("a <> b").distinct(), "small")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
