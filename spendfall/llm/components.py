"""Connected components of a graph given as edges, by alternating stars.

Each round every node learns the smallest node next to it and hands it to its larger
neighbours (large star), then to its smaller ones (small star), until nothing changes.
Minima are aggregated before they are shuffled and joined back by sort-merge joins, whose
hot keys Spark splits, so a node with a third of all edges is no longer task than others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendfall.llm.store import dropped, stored


def _star(edges: DataFrame) -> DataFrame:
    """Both ways of every edge, with the smallest node among each node and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    """One large and one small star over edges (u, v) with u > v."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    # below a node are smaller ones only: each of them, and the node itself, goes under the smallest
    star = _star(large)
    return star.select(F.col("v").alias("u"), F.col("m").alias("v")).union(star.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v) but the smallest of each component.

    The component is its smallest node, so a node that is not listed is its own component.
    Loops, repeated edges, either direction and nulls (no edge) may occur.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(edges, "edges")
    state = _state(now)
    while state[0]:
        then = stored(_round(now), "edges")
        dropped(now)
        now, before, state = then, state, _state(then)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
