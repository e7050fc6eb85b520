"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.store import drop_stored, stored


def _towards_least(edges: DataFrame) -> DataFrame:
    """Give each neighbour of a node the least node around; edges run from ``u`` to ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return edges.join(least, "u").select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has an edge; ``root`` is the least node of its component.

    Each round links the larger neighbours of a node to its least neighbour, then the
    smaller ones. The rows don't grow, and no node's neighbours are ever held together, so
    that a component may hold a third of all nodes. Each round is written to the shared
    folder; the rounds grow with the logarithm of the longest path.
    """
    seen, now = None, stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        star = _towards_least(down)
        small = star.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(star.select("u", F.col("m").alias("v")))
        after = stored(small.where("u <> v").distinct(), "edges")
        drop_stored(now)
        now = after
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
