"""Connected components of a link table, without a driver-side graph.

Alternating large-star and small-star rounds: every node hangs its larger
neighbours under its own smallest neighbour, until each component is one star.
Rounds grow with the logarithm of the longest chain. A round is two aggregates
and two joins on small rows; its result is written to the shared folder, so a
lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.tables import kept


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of `links` (a, b) and its component's smallest node.

    Repeated links, loops and links given both ways do no harm; null ends are
    ignored; no links give an empty table.
    """
    edges = kept(
        links.dropna(subset=["a", "b"])
        .filter("a <> b")
        .select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .distinct()
    )
    mark = _mark(edges)
    while True:
        stars = kept(_small_star(_large_star(edges)))
        new = _mark(stars)
        if new == mark:
            break
        edges, mark = stars, new
    roots = edges.select(F.col("low").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the links, to see whether a round changed any."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(20,0)"))).first())


def _parents(edges: DataFrame, node: str) -> DataFrame:
    return edges.groupBy(F.col("high").alias(node)).agg(F.min("low").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """A node's larger neighbours move under its smallest one."""
    moved = edges.join(_parents(edges, "low"), "low", "left")
    return moved.select(F.coalesce("least", "low").alias("low"), "high").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move under the smallest of them."""
    joined = edges.join(_parents(edges, "high"), "high")
    down = joined.filter("low <> least").select(F.col("least").alias("low"), F.col("low").alias("high"))
    return joined.select(F.col("least").alias("low"), "high").union(down).distinct()
