"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

AT_ONCE = 1 << 19  # edges that one task contracts at a time, about


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node) of every node that isn't the smallest one of its component."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    left, right = at[: len(u)], at[len(u) :]
    root = np.arange(len(names))
    while True:
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            break
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))  # roots only ever point to smaller ones
        while (root[root] != root).any():
            root = root[root]
    others = np.flatnonzero(root != np.arange(len(names)))
    return names[others], names[root[others]]


def _contracted(e: DataFrame) -> DataFrame:
    """The same components by at most as many edges: those that a task reads become stars, ``AT_ONCE`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            u, v = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(2))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in forest(u, v)], names=["u", "v"])

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= AT_ONCE:
                whole = star(held)
                if 2 * whole.num_rows > AT_ONCE:  # little was gained: go on with an empty forest
                    yield whole
                    held, n = [], 0
                else:
                    held, n = [whole], whole.num_rows
        if held:
            yield star(held)

    return materialise(e.mapInArrow(run, "u long, v long"), "forest")


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component: the smallest node that can be reached.

    Every task first contracts the edges that it reads. What is left of components that lie in several tasks goes through rounds of
    large-star and small-star steps: each links a node's neighbours to its smallest one, which keeps the components and turns them into
    stars; their number grows with the logarithm of the longest path. Neither step ever adds edges or moves one to a larger node,
    so the rounds end. Each is written to the shared folder. A node's neighbours only meet in aggregates and joins, or within a task's
    bounded share."""
    e = _contracted(edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).where("u is not null and v is not null and u <> v"))
    while True:
        # stars: no node has two centres, and no centre has one
        ends = e.select(F.col("u").alias("node"), F.col("v").alias("to")).unionByName(e.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("to")))
        ends = ends.groupBy("node").agg(F.min("to").alias("least"), F.max("to").alias("most"), F.max(F.col("to").isNull()).alias("centre"))
        if not ends.where("least <> most or (centre and least is not null)").take(1):
            return ends.select("node", F.coalesce("least", "node").alias("component"))
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: a larger neighbour goes to the smallest node near u
        e = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), "stars")
        # small star: smaller neighbours, and u itself, go to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = _contracted(e.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v"))
