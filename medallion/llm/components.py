"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every node hangs its larger, then its
smaller neighbours on the smallest one it knows, until nothing changes. Each step is one
aggregation and one join on the node; an aggregation combines before it shuffles, and
adaptive execution splits the join for a node with very many neighbours. The edges of each
round are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b): the smallest node reachable.

    Nulls, loops, repeated edges and either direction of an edge are allowed; a node whose
    only edges are loops is left out. No edges give no rows.
    """
    stars = written(
        edges.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
        .select("a", "b").distinct(),
        "edges",
    )
    state = _state(stars)
    while True:
        stars = written(_small_star(_large_star(stars)), "edges")
        following = _state(stars)
        if following == state:
            break
        state = following
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _state(edges: DataFrame) -> tuple:
    """Tells two edge tables apart: their number and a sum over hashes."""
    hashed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs each node's larger neighbours on the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_least"))
    return (
        both.join(smallest, "a").where("b > a")
        .select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs each node and its smaller neighbours on the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("_least"))
    hung = edges.join(smallest, "a").where("b <> _least")
    hung = hung.select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return smallest.select("a", F.col("_least").alias("b")).unionByName(hung).distinct()
