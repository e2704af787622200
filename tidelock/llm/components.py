"""Connected components of edges that are spread over the cluster: alternating large-star and small-star rounds.

Kiveris et al., Connected Components in MapReduce and Beyond, 2014.  Each round
is an aggregate and a join of edges, until all that is left are stars; nothing is
collected but counts.  Only graphs of at most FEW_EDGES edges are settled at once
on the driver, as rounds cost seconds whatever they hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

ROUNDS = 60
#: Edges that come to the driver, 16 bytes each; a larger graph never does.
FEW_EDGES = 100_000


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b), the root being the smallest node that it reaches.

    Loops and repeated edges don't matter; without edges there are no rows.  Edges are read several times.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if edges.count() <= FEW_EDGES:
        few = edges.toArrow()
        node, root = settled(few.column("u").to_numpy(), few.column("v").to_numpy())
        return scratch.spark.createDataFrame(pa.table({"node": pa.array(node, pa.int64()), "root": pa.array(root, pa.int64())}))
    now = edges
    for k in range(1, ROUNDS):
        # large star: each node's larger neighbours join the smallest of its neighbours and itself
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: each node and its smaller neighbours join the smallest of them
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        now = scratch.keep(small, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        if _stars(now):
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u: then every v, being less than its u, is the least of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).where("leaf + root > 1 and leaf > 0").limit(1).count() == 0


def settled(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges (u[i], v[i]) and the smallest node that each one reaches."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b, root = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]
