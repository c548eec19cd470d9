"""Embedding near-duplicates by a pivot-permutation index.

Pivots are picked from a bounded, seeded sample, each as far as can be from those before it and none within the threshold
of another: drawn evenly, a large group of near copies would take many of them, and its members would be told apart by the
noise among those. Their number grows with the root of the number of vectors, so the inverted lists stay short. Each vector
is described by its NEAREST nearest pivots, in order; the inverted lists are keyed by SHARED of them together, so two
vectors meet in a list exactly when they share at least SHARED near pivots. Lists hold ids; lists of one vector end there,
and only the entries of the others fetch their vectors. Candidates of equal label are verified by cosine in double
precision. A pair that meets in several lists is counted in one of them only: that of the smallest pivots they share.

Equal vectors of one label are one class, so copies never meet pair by pair; a class counts by its size.

Cases: null or zero vectors, and those with null or non-finite components, or a null label, link with nothing and form
their own component; vectors of unlike length never link; a null id gets no component; repeated rows each get a row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lanewright.llm.blocks import bucket_pairs, dealt_buckets, whole_buckets
from lanewright.llm.components import connected_components, star_edges
from lanewright.llm.workers import tidy
from lanewright.scratch import join_checked, materialise

#: Pivots for n vectors: PER_ROOT times the root of n within these bounds.
PIVOTS, PER_ROOT = (64, 2048), 2
PIVOT_BITS = 11
#: They are picked from so many vectors of a length, or fewer where these would have more than SAMPLE_NUMBERS components.
SAMPLE, SAMPLE_NUMBERS = 4096, 2_000_000
NEAREST, SHARED = 7, 3
PIVOT_SEED = 11


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(vec: str = "embedding", label: str = "label"):
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def pivot_count(vectors: int) -> int:
    return int(min(max(PER_ROOT * vectors**0.5, PIVOTS[0]), PIVOTS[1]))


def spread_pivots(sample: np.ndarray, threshold: float, count: int) -> np.ndarray:
    """Farthest first: the first unit vector, then always the one least like those taken, until all are within the threshold."""
    taken, like = [0], sample @ sample[0]
    while len(taken) < count:
        i = int(np.argmin(like))
        if like[i] >= threshold:
            break
        taken.append(i)
        like = np.maximum(like, sample @ sample[i])
    return sample[taken]


def near_pivots(pivots: np.ndarray, vectors: np.ndarray, nearest: int) -> np.ndarray:
    return np.argsort(-(unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :nearest]


def describe(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """Adds to each class ``near``, its near pivots in ascending order, and ``keys``, the inverted lists it stands in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                vectors = part.column("embedding").to_pylist()
                near, keys = [[]] * len(vectors), [[]] * len(vectors)
                for dim in {len(v) for v in vectors} & pivots.keys():
                    own = [i for i, v in enumerate(vectors) if len(v) == dim]
                    order = np.sort(near_pivots(pivots[dim], np.array([vectors[i] for i in own], np.float64), nearest), axis=1)
                    m = order.shape[1]
                    key = np.zeros((len(own), math.comb(m, min(shared, m))), np.int64)
                    for k, c in enumerate(combinations(range(m), min(shared, m))):
                        for i in c:
                            key[:, k] = key[:, k] << PIVOT_BITS | order[:, i]
                    for i, o, k in zip(own, order, key, strict=True):
                        near[i], keys[i] = o, k
                more = [pa.array(near, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "near", "keys"])

    return classes.mapInArrow(tidy(run), StructType([*classes.schema.fields, StructField("near", ArrayType(IntegerType())), StructField("keys", ArrayType(LongType()))]))


def list_rows(described: DataFrame) -> DataFrame:
    """A row per class and list with others in it: (label, key, near, rep, size, embedding)."""
    entries = materialise(described.select("label", F.explode("keys").alias("key"), "rep", "cls"), "vector-lists")
    several = entries.groupBy("label", "key").agg(F.count("*").alias("n")).filter("n > 1").select("label", "key")
    live = join_checked(entries, materialise(several, "vector-several"), ["label", "key"], "left_semi")
    return live.select("key", "rep", "cls").join(described.drop("keys"), ["rep", "cls"]).select("label", "key", "near", "rep", "size", "embedding")


def verified(rows: DataFrame, threshold: float, shared: int = SHARED) -> DataFrame:
    """From dealt lists: spanning edges (a, b, null), and (a, null, links) with the number of vectors linked to class a."""

    def lists_of(t: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = t.column(column).combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        return sizes, lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, end in whole_buckets(batches, ["label", "key"], rows=20_000):
            t = t.combine_chunks()
            key, rep, size, lo, hi, side = (t.column(c).to_numpy() for c in ("key", "rep", "size", "lo", "hi", "side"))
            dims, flat, at = lists_of(t, "embedding")
            vec = np.zeros((t.num_rows, dims.max()))
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                vec[own, :dim] = unit(flat[at[own][:, None] + np.arange(dim)])
            few, flat, at = lists_of(t, "near")
            near = np.full((t.num_rows, few.max()), -1)
            for m in np.unique(few):
                own = np.flatnonzero(few == m)
                near[own, :m] = flat[at[own][:, None] + np.arange(m)]
            last = key & ((1 << PIVOT_BITS) - 1)  # the highest of the list's pivots
            us, vs = [], []
            for i, j in bucket_pairs(end, lo, hi, side):
                ok = (dims[i] == dims[j]) & (rep[i] != rep[j])
                i, j = i[ok], j[ok]
                ok = np.einsum("ij,ij->i", vec[i], vec[j]) >= threshold
                i, j = i[ok], j[ok]
                below = (near[i][:, :, None] == near[j][:, None, :]).any(axis=2) & (near[i] < last[i][:, None]) & (near[i] >= 0)
                ok = below.sum(axis=1) == np.minimum(shared, few[i]) - 1
                us.append(i[ok])
                vs.append(j[ok])
            u, v = (np.concatenate(x) if x else np.zeros(0, int) for x in (us, vs))
            if len(u):
                ids, where = np.unique(rep, return_inverse=True)
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, where[u], size[v])
                np.add.at(links, where[v], size[u])
                a, b = star_edges(rep, u, v)
                has = np.flatnonzero(links)
                none = lambda n: pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([pa.array(a), pa.array(ids[has])]),
                    pa.concat_arrays([pa.array(b), none(len(has))]),
                    pa.concat_arrays([none(len(a)), pa.array(links[has])]),
                ], names=["a", "b", "links"])

    return rows.mapInArrow(tidy(run), "a long, b long, links long")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept)."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"), F.col(label_col).alias("label"))
    good = src.filter(usable())
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")).filter("rep IS NOT NULL")
    classes = classes.withColumn("cls", F.xxhash64("label", "embedding"))
    classes = materialise(classes, "vector-classes")
    # distinct vectors by seeded hash: at most SAMPLE rows for each vector length reach the driver
    pivots = {}
    for (dim,) in classes.select(F.size("embedding")).distinct().collect():
        alike = classes.filter(F.size("embedding") == dim)
        count = pivot_count(alike.count())
        n = max(count, min(SAMPLE, SAMPLE_NUMBERS // dim))
        some = alike.orderBy(F.xxhash64("rep", F.lit(PIVOT_SEED)), "rep").limit(n)
        pivots[dim] = spread_pivots(unit(np.array([r.embedding for r in some.select("embedding").collect()], np.float64)), threshold, count)
    described = materialise(describe(classes, pivots), "vector-described")
    rows = dealt_buckets(list_rows(described), ["label", "key"], "rep")
    found = materialise(verified(rows, threshold), "vector-links")
    comps = connected_components(found.filter("b IS NOT NULL"))
    links = found.filter("links IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    of_class = classes.join(links, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("label").alias("_l"), F.col("embedding").alias("_e"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"),
    )
    # the vectors join their class by value; a class's key is (label, vector)
    linked = good.join(of_class, (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e")), "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    alone = src.filter(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
