"""Connected components of an edge table, by alternating star contraction.

Each round links every node's larger neighbours to its smallest one (large
star), then every node and its smaller neighbours to the smallest of them
(small star). Both are one grouped minimum and one join, so a node with very
many edges is pre-aggregated before the shuffle and its rows may be split in
the join. The edges end as stars: every node points to the smallest id it
can reach. Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """edges(a, b): for each node, link its larger neighbours to the
    smallest among itself and its neighbours. The minima are a written
    table, so that the join may split the rows of a node with very many
    neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(
        both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}_least")
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """edges(a > b): link every node and its smaller neighbours to the
    smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node that has
    an edge. ``edges``: two columns of ids; null ids and loops are ignored,
    repeated and reversed edges count once."""
    a, b = edges.columns
    current = materialise(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") > F.col("b"))).distinct(), name)
    mark = _mark(current)
    while mark[0]:
        current = materialise(_small_star(_large_star(current, name)), name)
        new = _mark(current)
        if new == mark:
            break
        mark = new
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum: equal when nothing moved."""
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first())
