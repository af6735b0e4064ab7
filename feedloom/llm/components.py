"""Connected components by alternating large-star and small-star rounds.

Each round is two joins and two grouped minima over the edge table; the edges
of a component end as a star around its smallest node.  Nothing but two
numbers a round reaches the driver.  The minima are written before the join,
so both sides of it come from exchanges and adaptive execution can split the
partition of a node with very many edges.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spill


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): each node of an edge with the smallest node it reaches.

    ``edges`` has two columns of one orderable type; loops, repeats, nulls and
    both directions are allowed (an edge with a null end is no edge).  Nodes
    without an edge are not returned.  An empty table gives an empty table.
    Raises if ``max_rounds`` rounds do not settle it.
    """
    a, b = edges.columns[:2]
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = spill(e, "edges")
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = spill(both.groupBy("u").agg(F.min("v").alias("m"))
                    .withColumn("m", F.least("u", "m")), "large-star")
        big = (both.join(low, "u").where("v > u")
               .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        big = spill(big, "edges")
        low = spill(big.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        joined = big.join(low, "u")
        e = spill(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")))
            .distinct())


def _state(e: DataFrame) -> tuple:
    """Count and order-free fingerprint of the edge set."""
    r = e.agg(F.count("*").alias("n"),
              F.sum((F.xxhash64("u", "v") % F.lit(1 << 30))).alias("h")).first()
    return (r["n"], r["h"])


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` points by links i-j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
