"""Connected components of a table of links by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round on (u, v): neighbours move to the smallest neighbour of the node between them."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.unionByName(turned) if large else (edges.where("v < u").unionByName(turned.where("v < u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def component_roots(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` is (x, y), root the smallest node reachable."""
    edges = materialise(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                        .where("u <> v").distinct(), "component-edges")
    state = None
    for _ in range(max_rounds):
        edges = materialise(_star(_star(edges, True), False), "component-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise ValueError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
