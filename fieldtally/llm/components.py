"""Connected components of a graph given as edges, by alternating star contraction.

Each round relabels edges towards the smallest neighbour (large star), then towards the smallest smaller one
(small star), until nothing changes; the number of rounds grows with the logarithm of the longest path. Before
that, each partition replaces its edges by a spanning forest, so a round never handles more than one edge a node
and partition. Rounds are written to the shared folder, which also keeps the plan short. A node with very many
edges is summed up by a combined minimum and a join that can be split, never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.shared import saved, ship


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the edges (u, v) the smallest node of its component: nodes other than their smallest, smallest."""
    nodes, which = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = which[: len(u)], which[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[away], nodes[label[away]]


def _contracted(edges: DataFrame, at_once: int = 500_000) -> DataFrame:
    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def rows() -> pa.RecordBatch:
            a, b = forest(np.concatenate(u), np.concatenate(v))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

        for batch in batches:
            u.append(batch.column(0).to_numpy())
            v.append(batch.column(1).to_numpy())
            if sum(map(len, u)) > at_once:
                yield rows()
                u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        yield rows()

    ship(edges.sparkSession)
    return edges.select("u", "v").mapInArrow(shrink, "u bigint, v bigint")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = both.where("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = (down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node with an edge (long columns u and v) to another node."""
    now = saved(_contracted(edges.where("u <> v")), "edges")
    before = None
    while True:
        now = saved(_star(_star(now, True), False), "edges")
        state = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
