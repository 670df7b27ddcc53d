"""Connected components of an edge list, by alternating star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut


def _linked_to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Every node's neighbours (larger ones, or smaller ones and itself) are linked to the least of
    its neighbours and itself."""
    if larger_only:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges                               # a > b: b is the smaller neighbour
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = near.join(least, "a")
    if larger_only:
        joined = joined.where("b > a")
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs -> (node, root), root the least node of the component, for every
    node that is not its own root."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    e = cut(e, "edges")
    while True:
        large = _linked_to_least(e, True).where("a > b")
        e = cut(_linked_to_least(large, False).where("a > b").distinct(), "edges")
        # done when all is stars: no node has two smaller neighbours, or one while it is another's
        roles = e.select(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
            e.select(F.col("b").alias("v"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
        open_ = roles.groupBy("v").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child + parent > 1")
        if open_.agg(F.count(F.lit(1))).first()[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
