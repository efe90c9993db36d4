"""Connected components of very large graphs, label = smallest member.

Large-star and small-star steps in turn (a published map-reduce method): each
step hangs a node's neighbours on the smallest one it knows of. Both are an
aggregate with map-side combine and one join, so a node with a third of all
edges is never gathered: its edges are rows of a join, which the planner splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.session import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than u go to the smallest of u and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("least"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours go to the smallest of them. src > dst holds."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    moved = edges.join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.union(least.select("src", F.col("least").alias("dst")))


def _tidy(edges: DataFrame) -> DataFrame:
    ordered = edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    return ordered.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another one.

    `edges`: columns src and dst, long. Direction, repeats and loops don't
    matter; edges with a null end are ignored. No edges give no rows.
    """
    clean = edges.where("src is not null and dst is not null")
    current = stage(_tidy(clean), "edges")
    seen = None
    while True:
        current = stage(_tidy(_small_star(_tidy(_large_star(current)))), "edges")
        # Two sums of hashes tell whether a round has changed anything.
        mark = current.agg(
            F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")), F.sum(F.hash("dst", "src").cast("long"))
        ).first()
        if mark == seen:
            break
        seen = mark
    roots = current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
