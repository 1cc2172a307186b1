"""Connected components of a links table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (a, b), a > b. Minima are aggregated before they meet the edges, so
    the neighbours of one node are never gathered."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    met = both.join(low, "a")
    if small:
        # smaller neighbours and the node itself go to the smallest neighbour
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    else:
        # larger neighbours go to the smallest node around
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no larger one, or larger ones only: then that neighbour
    is its root. Asked of the nodes in one pass, as a further round that changes nothing costs several."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.below").alias("below"), F.max("e.above").alias("above"))
    return nodes.agg(F.count_if((F.col("below") > 0) & (F.col("below") + F.col("above") > 1))).first()[0] == 0


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: comparable ids, any order, repeats and loops
    allowed); root is the smallest id reachable. An empty table gives an empty one."""
    one = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(one.where("a <> b").distinct(), "edges")
    while not _all_stars(now):
        now = stage(_star(_star(now, small=False), small=True).distinct(), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
