"""Connected components of a table of edges."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_EDGES = 500_000


def _contracted(batches):
    """Of every run of edges a star per component: what joins the same nodes with at most as many edges."""

    def stars(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        left, right = index[: len(a)], index[len(a) :]
        root = np.arange(len(nodes))
        # Every node takes the smallest root around it and then its root's root, until nothing moves.
        while True:
            low = np.minimum(root[left], root[right])
            new = root.copy()
            np.minimum.at(new, root[left], low)
            np.minimum.at(new, root[right], low)
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        moved = root != np.arange(len(nodes))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]]})

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= TASK_EDGES:
            every = pd.concat(held)
            yield stars(every["a"].to_numpy(), every["b"].to_numpy())
            held, size = [], 0
    if size:
        every = pd.concat(held)
        yield stars(every["a"].to_numpy(), every["b"].to_numpy())


def _star(pairs: DataFrame) -> DataFrame:
    """All pairs (a, b), and the smallest neighbour of each a, at most itself."""
    return pairs.join(pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least")), "a")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node that is not its own root.

    ``edges`` has the long columns a and b. Each task first makes stars of the edges it has. Then large-star
    and small-star steps alternate, a sum per node and a join each, until every edge ends in a root; their
    number grows with the logarithm of the graph's size. Every round is written to the shared folder.
    """
    edges = materialise(edges.where("a <> b").select("a", "b").mapInPandas(_contracted, "a long, b long"), "edges")
    while True:
        inner = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        twice = edges.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high")
        if inner.isEmpty() and twice.isEmpty():
            return edges.distinct().select(F.col("a").alias("node"), F.col("b").alias("root"))
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(around).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        small = _star(large)
        hung = small.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        kept = small.select("a", F.col("least").alias("b"))
        edges = materialise(hung.unionByName(kept).distinct().mapInPandas(_contracted, "a long, b long"), "stars")
