"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.hash("node", "near").cast("long"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (columns node, near).

    The component is the smallest node reachable. Alternating star contraction
    (large star, small star): each round hangs neighbours under the smallest
    one, by a grouped minimum and a join, so no group is ever gathered and a
    hub's links may be split over tasks. Rounds are written to the shared
    folder; their number grows with the logarithm of the longest path.
    """
    links = links.select("node", "near").filter("node <> near").distinct()
    links = materialise(links, "links")
    before = None
    while True:
        both = links.union(links.select(F.col("near").alias("node"), F.col("node").alias("near")))
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
        large = (both.filter("near > node").join(least, "node")
                 .select(F.col("near").alias("node"), F.col("least").alias("near")).distinct())
        large = large.filter("node <> near")
        down = large.select(F.greatest("node", "near").alias("node"), F.least("node", "near").alias("near"))
        least = down.groupBy("node").agg(F.min("near").alias("least"))
        hung = down.join(least, "node")
        small = (hung.select(F.col("near").alias("node"), F.col("least").alias("near"))
                 .union(least.select("node", F.col("least").alias("near"))).filter("node <> near").distinct())
        links = materialise(small, "links")
        now = _checksum(links)
        if now == before:
            break
        before = now
    roots = links.select(F.col("near").alias("node")).distinct()
    return links.select("node", F.col("near").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
