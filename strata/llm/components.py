"""Connected components of a graph that is spread over the cluster.

First every task contracts the edges it reads to a spanning forest, without a
shuffle. Then come alternating large-star and small-star steps: each is an
aggregation to the smallest neighbour of a node, a join of it back to the
node's edges and a ``distinct``. A hot node's edges meet only in the join,
whose large partitions Spark splits. After every round the edges are written
to the shared folder, so lost executors cost one round at most; the driver
sees one flag a round: whether every node points straight at its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, written

MAX_ROUNDS = 64
CONTRACTED = 1 << 20


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For 0..n-1 the smallest number reachable over the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        ends, others = root[a], root[b]
        low = np.minimum(ends, others)
        np.minimum.at(root, ends, low)
        np.minimum.at(root, others, low)
        # up to the ends of all chains: only these may be hooked, or what hangs on them is lost
        while (root[root] != root).any():
            root = root[root]
        left = root[a] != root[b]
        a, b = a[left], b[left]
    return root


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of each run of at most about ``CONTRACTED`` edges."""

    def forest(hi: list, lo: list) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([*hi, *lo]), return_inverse=True)
        half = len(at) // 2
        root = roots(len(nodes), at[:half], at[half:])
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["hi", "lo"])

    hi, lo, held = [], [], 0
    for batch in batches:
        hi.append(batch.column("hi").to_numpy())
        lo.append(batch.column("lo").to_numpy())
        held += batch.num_rows
        if held > CONTRACTED:
            yield forest(hi, lo)
            hi, lo, held = [], [], 0
    if held:
        yield forest(hi, lo)


def _is_flat(edges: DataFrame) -> bool:
    """Whether no node has two edges down and no edge ends where another begins."""
    down = edges.groupBy("hi").agg(F.count("*").alias("n"))
    twice = down.where("n > 1").select("hi")
    chained = edges.select(F.col("lo").alias("hi")).distinct().join(down.select("hi"), "hi", "left_semi")
    return twice.unionAll(chained).isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has an edge to another; component: its smallest node.

    Nodes are integers of up to 64 bits, none of them null.
    """
    kind = dict(edges.dtypes)[a]
    prepare(edges.sparkSession)
    directed = edges.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo")).where("hi <> lo")
    now = written(directed.mapInArrow(_contracted, "hi long, lo long").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _is_flat(now):
            break
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct())
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(below, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionAll(below.select("hi", F.col("m").alias("lo"))).distinct())
        now = written(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.unionAll(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()).select(
        F.col("node").cast(kind), F.col("component").cast(kind))
