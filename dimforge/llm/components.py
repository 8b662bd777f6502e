"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared


def _star(edges: DataFrame, centre: DataFrame) -> DataFrame:
    """Point every neighbour ``v`` of ``u`` at the smallest node next to ``u``.  The centre
    is a grouped minimum joined back, so a node with very many links is no single task."""
    return edges.join(centre, "u")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, component), component the smallest node reachable.

    Large-star links each larger neighbour of a node to the smallest node around it;
    small-star does so for the smaller neighbours.  Both keep connectivity, and the edges
    end as stars around the smallest nodes.  Self-links and repeated links change nothing;
    no links give no rows."""
    a, b = F.col("a"), F.col("b")
    edges = shared(
        links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )

    def mark(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _star(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, low)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = shared(small.filter("u <> v").distinct())
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
