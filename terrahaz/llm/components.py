"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and two joins on the nodes; minima combine before the shuffle, so
a hub of any degree is no single task's work. Rounds are staged in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrahaz.llm import tables


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (large star) or the smaller (small star) neighbours of each node, and the
    node itself, to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.where("b > a") if large else both
    out = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each node of ``edges`` (``a``, ``b``) and the least node it reaches."""
    now = tables.staged(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        now = tables.staged(_star(_star(now, True), False), "components")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
