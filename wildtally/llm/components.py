"""Connected components of a graph held in a DataFrame, without gathering edges or nodes on one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wildtally.llm.shared import remove, stored

#: Edges that a single task connects: few rounds are left when so few are, and each costs the driver several plans.
REST = 4096


def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, to (the smallest node reachable) for every end of the edges (a, b) of all batches."""
    nodes, ends = np.unique(np.concatenate([np.empty((0, 2), np.int64), *(np.stack([c.to_numpy() for c in b.columns], axis=1) for b in batches)]), return_inverse=True)
    label, (a, b) = np.arange(len(nodes)), ends.reshape(-1, 2).T
    while (label[a] != label[b]).any():
        low = np.minimum(label[a], label[b])
        for end in (a, b):
            np.minimum.at(label, label[end], low)
        while (label != label[label]).any():
            label = label[label]
    yield pa.record_batch([pa.array(nodes), pa.array(nodes[label])], names=["node", "to"])


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every end of edges(a, b); both ends are non-null longs.

    Each round, every node points to the neighbour (or itself) that comes first in a fresh random order, and edges are
    redrawn between what their ends point to. That leaves a constant share of the nodes at most, so the rounds grow with
    the logarithm of the largest component; the last REST edges are connected by one task. A node with very many edges
    is reduced before it is shuffled, and joins on it can be split, as nothing behind them needs its rows together. Each
    round's rows are a written table, whose size is known: the sizes that plans guess for joins multiply from round to
    round until planning takes minutes. A table that a later one replaces is deleted. Loops and repeated edges change
    nothing; no edges give no rows.
    """
    spark = edges.sparkSession
    live, at = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    pointers: list[tuple[DataFrame, str]] = []
    while held := live.count():
        if held <= REST:
            pointers.append(stored(live.coalesce(1).mapInArrow(pointed, "node long, to long"), "pointers"))
            break
        place = lambda c, turn=len(pointers): F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("to"))
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(place("b")).alias("near"))
        pointers.append(stored(near.select(F.col("a").alias("node"), F.least(F.col("near"), place("a"))["to"].alias("to")), "pointers"))
        points = pointers[-1][0]
        left = live.join(points.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").select("x", "b")
        moved = left.join(points.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        old, (live, at) = at, stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        remove(spark, old)
    remove(spark, at)
    if not pointers:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    roots, at = pointers.pop()
    while pointers:
        on = roots.select(F.col("node").alias("to"), F.col("to").alias("root"))
        (points, older), old = pointers.pop(), at
        roots, at = stored(points.join(on, "to", "left").select("node", F.coalesce("root", "to").alias("to")), "roots")
        remove(spark, old)
        remove(spark, older)
    smallest = roots.groupBy("to").agg(F.min("node").alias("component"))
    return roots.join(smallest, "to").select("node", "component")
