"""Connected components by contraction.

In each round every node picks the first of itself and its neighbours in some order of nodes, and the graph is
contracted along these picks; loops and repeated edges go. Orders alternate between node ids, which contract stars around
a smallest node at once, and random ones, which shrink any graph by a constant factor on average. So the number of
rounds grows with the logarithm of the graph, and every step is a join or a pre-aggregated minimum over written tables.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolink.plans.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b), which are longs; its smallest node names a component.

    Repeated edges and loops change nothing; a node that has loops only is its own component.
    """
    left = stage(_tidy(edges.select("a", "b")), "edges")
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    picks: list[DataFrame] = []
    while left.filter("a <> b").take(1):
        seed = len(picks) // 2 if len(picks) % 2 else None

        def place(node: Column, seed=seed) -> Column:
            order = F.lit(0) if seed is None else F.xxhash64(node, F.lit(seed))
            return F.struct(order.cast("long").alias("order"), node.alias("node"))

        ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        picked = stage(
            left.select(F.explode(ways).alias("e"))
            .groupBy(F.col("e.a").alias("node"))
            .agg(F.min(place(F.col("e.b"))).alias("first"))
            .select("node", F.least(F.col("first"), place(F.col("node")))["node"].alias("pick")),
            "picks",
        )
        at_a = picked.select(F.col("node").alias("a"), F.col("pick").alias("pick_a"))
        at_b = picked.select(F.col("node").alias("b"), F.col("pick").alias("pick_b"))
        moved = left.join(at_a, "a").join(at_b, "b").select(F.col("pick_a").alias("a"), F.col("pick_b").alias("b"))
        left = stage(_tidy(moved.filter("a <> b")), "edges")
        picks.append(picked)

    if not picks:
        return nodes.select("node", F.col("node").alias("component"))
    # From the last and smallest round back to the first.
    ends = picks.pop()
    while picks:
        later = ends.select(F.col("node").alias("pick"), F.col("pick").alias("end"))
        ends = picks.pop().join(later, "pick", "left").select("node", F.coalesce("end", "pick").alias("pick"))
    ends = stage(ends, "ends")
    names = ends.groupBy("pick").agg(F.min("node").alias("component"))
    named = ends.join(names, "pick").select("node", "component")
    return nodes.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number in the component of each of n numbers linked by pairs."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        low = np.minimum(a, b)
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while (jumped := new[new]).tobytes() != new.tobytes():
            new = jumped
        if (new == label).all():
            break
        label = new
    return label
