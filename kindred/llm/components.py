"""Connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import forget, freeing, stored


#: Up to so many edges (16 MB) one task labels them all; more take star steps.
ONE_TASK = 1 << 20


def labelled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that it is connected with) of edges in memory."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _in_one_task(edges: DataFrame) -> DataFrame:
    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"a": [], "b": []}, dtype="int64"), *batches])
        node, component = labelled(rows["a"].to_numpy(np.int64), rows["b"].to_numpy(np.int64))
        yield pd.DataFrame({"node": node, "component": component})

    return edges.select("a", "b").coalesce(1).mapInPandas(freeing(label), "node long, component long")


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges (a long, b long; a stored table).

    Without edges the result is empty; nodes of loops are kept. Beyond one_task edges it alternates large-star and
    small-star steps: the number of edges never grows, each step joins edges with their nodes' smallest neighbours and
    is written to the shared folder, and a node with very many edges is aggregated partially and its join can be split.
    """
    if edges.count() <= one_task:
        return _in_one_task(edges)
    current = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = current.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    before = None
    while True:  # the number of steps is logarithmic in the longest path
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Each larger neighbour of u moves to u's smallest neighbour.
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a <> b").distinct()
        # Each node keeps its smallest smaller neighbour and hands that to the others.
        smallest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(smallest, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a <> b").distinct()
        after = stored(small, "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None:  # the first table is read again for the nodes
            forget(current)
        if state == before:
            current = after
            break
        before, current = state, after
    found = current.groupBy("b").agg(F.min("a").alias("a"))
    return nodes.join(found, nodes["node"] == found["b"], "left").select("node", F.coalesce("a", "node").alias("component"))
