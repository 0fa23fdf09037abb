"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthstar.llm.tables import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its smallest node.

    Large-star and small-star rounds: each node's neighbours are pointed at the
    smallest of them until every node points at the root of its component. Every
    round is two aggregates and two joins on all links, written to the shared
    folder, and the round before it is deleted; a node with very many links is folded before the shuffle and its
    partition is split by the adaptive join. The rounds grow with the logarithm
    of the longest chain. Links of a node with itself and null ends are ignored.
    """
    edges = _distinct(
        links.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        )
    )
    edges, seen = _written(edges)
    while seen[0]:
        last = edges
        edges, now = _written(_small_star(_large_star(last)))
        discard(last)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a table, and what tells two rounds apart."""
    table = stored(edges, "links")
    row = table.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("decimal(20,0)")).alias("mark"),
    ).first()
    return table, (row["n"], row["mark"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the smallest of the node and all its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    return _distinct(larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where(F.col("v") != F.col("m"))
    return _distinct(
        others.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    )
