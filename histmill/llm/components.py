"""Connected components of a link table, by alternating large and small stars.

Each round is two grouped minima joined back to the links; no component is ever gathered
in one place. A node with very many links costs one partial minimum per map task, and the
join back on it is a sort-merge join whose hot side AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import drop_stage, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on links (a, b) with a > b, giving links of the same form.

    Every node hands its smallest neighbour (or itself) on: in the large step to its larger
    neighbours, in the small step to its smaller ones and itself.
    """
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stage(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    hung = near.join(least, "u")
    hung = hung.filter(F.col("v") > F.col("u")) if large else hung.unionByName(
        least.select("u", F.col("u").alias("v"), "m"))
    out = stage(hung.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
    drop_stage(least)
    return out


def _open(edges: DataFrame) -> bool:
    """Whether the links are not yet stars: a node has two centres, or a centre has one."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("rays"), F.lit(0).alias("centre")).union(
        edges.select(F.col("b"), F.lit(0), F.lit(1)))
    seen = ends.groupBy("n").agg(F.sum("rays").alias("rays"), F.max("centre").alias("centre"))
    return not seen.filter("rays > 1 or (rays = 1 and centre = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label): for every node of ``links`` (a, b) the smallest node it can reach."""
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct())
    while _open(edges):
        spread = _star(edges, large=True)
        closed = _star(spread, large=False)
        drop_stage(edges)
        drop_stage(spread)
        edges = closed
    return stage(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b"), F.col("b")).distinct()))
