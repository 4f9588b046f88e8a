"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node reachable, for every node with an edge.

    Large-star and small-star steps in turn (Kiveris et al., 2014): in each, all
    neighbours of a node are tied to the least of them, until nothing changes.
    Every step is one aggregation and joins by node; only two sums of the edges
    reach the driver. Each step's edges are checkpointed. A hub is split by
    adaptive execution, since the star of a node is formed by a join and not
    by gathering its neighbours. Loops (a = b) and null ends are ignored.
    """
    edges = checkpointed(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        mark = _mark(edges)
        if mark == before or mark[0] == 0:
            break
        before = mark
        edges = checkpointed(_small_star(_large_star(edges)))
    least = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    inner = least.select(F.col("u").alias("node"), "component")
    return inner.unionByName(roots.join(inner.select("node"), "node", "left_anti"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes of one block, the least node of its component under the edges a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
