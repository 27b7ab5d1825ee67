"""Connected components of an edge table, by alternating star contraction.

Every round joins each node's edges with the smallest neighbour of that node, so no node's
neighbours meet in one place, however many it has. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat.plans.lineage import materialise

_MOST_ROUNDS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on the smallest one: the larger neighbours, or the smaller."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else down
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    low = low.select("a", F.least("a", "low").alias("low"))
    hung = both.join(low, "a")
    if large:
        hung = hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        own = low.select("a", F.col("low").alias("b"))
        hung = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own)
    return hung.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node that has an edge; the root is the component's smallest node.

    ``edges`` has two integer columns; direction, repetition and loops don't matter, but a node
    with loops only is not returned. Nulls are no nodes.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).dropna().filter("a != b").distinct()
    edges = materialise(edges, "edges")
    before = None
    for _ in range(_MOST_ROUNDS):
        edges = materialise(_star(_star(edges, True), False), "edges")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
