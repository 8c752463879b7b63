"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); the component is its least node.

    Every round ends in a stored table.  Minima are summed before the shuffle, and the joins are
    equi-joins with one row for each node on one side, so a hub costs no single task its edges.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node move to its least neighbour (or itself).
        large = both.filter("b > a").join(_smallest(both), "a")
        large = large.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        # Small star: neighbours below a node, and the node, move to the least of them.
        large = stored(large, label)
        small = large.join(_smallest(large), "a")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(small.select("a", F.col("least").alias("b")))
        now = stored(small.filter("a <> b").distinct(), label)
        after = _state(now)
        if after == state:
            break
        state = after
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
