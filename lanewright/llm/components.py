"""Connected components: a numpy step inside tasks, and a distributed one over edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.workers import tidy
from lanewright.scratch import join_checked, materialise

#: An edge table of at most this many rows (two ids each) is finished in one task; a larger one takes another round.
FINISH_EDGES = 200_000


def local_roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of n nodes."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def star_edges(nodes: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links u[i]-v[i] (positions in ``nodes``) reduced to edges (node, smallest node of its local component)."""
    ids, at = np.unique(nodes, return_inverse=True)
    root = local_roots(len(ids), at[u], at[v])
    own = np.flatnonzero(root != np.arange(len(ids)))
    return ids[own], ids[root[own]]


def _finish(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of an edge table (u, v) of checked size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if parts:
            u, v = (np.concatenate(x) for x in zip(*parts, strict=True))
            ids, at = np.unique(np.concatenate((u, v)), return_inverse=True)
            root = local_roots(len(ids), at[: len(u)], at[len(u) :])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["node", "component"])

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).coalesce(1).mapInArrow(tidy(run), "node long, component long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40, finish: int = FINISH_EDGES) -> DataFrame:
    """Rows (node, component) for every node of an undirected edge table; component is the smallest node reachable.

    Alternates the large-star and small-star steps: each links a node's neighbours to the smallest of them, so chains
    halve and the edge count never grows. A round is written to the scratch folder, which cuts the lineage. Nothing but
    two sums reaches the driver. As soon as at most ``finish`` edges are there, one task joins them up, with the same result.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e, seen = materialise(e, "components"), None
    if e.count() <= finish:
        return _finish(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the least neighbours are tables of their own: broadcast when few, and otherwise joined straight from a shuffle,
        # where adaptive execution can split the rows of a hub
        low = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-low")
        large = materialise(join_checked(both, low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components-large")
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "components-low")
        small = join_checked(large, low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("x"), "m"), F.struct(F.col("v").alias("x"), "m"))).alias("p"))
        small = small.select(F.col("p.x").alias("u"), F.col("p.m").alias("v")).filter("u <> v").distinct()
        e = materialise(small, "components")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        if now[0] <= finish:
            return _finish(e)
        seen = now
    else:
        raise RuntimeError("components did not settle")
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
