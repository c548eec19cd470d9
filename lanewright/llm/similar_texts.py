"""Near-duplicate texts by the Jaccard similarity of their five-word shingles; the pipeline's rule.

Two texts are linked when their sets of shingles agree to SIMILAR or more. Candidates come from BANDS keys of ROWS minima
each over the same shingles; every candidate is then compared by its whole sets, so nothing below SIMILAR is ever linked.
A pair at SIMILAR exactly meets in no band with probability (1 - SIMILAR^ROWS)^BANDS, below 1 in 10,000.

The first candidates are those of SimHash with pigeonring (``simhash.linked``, 4 bits): texts of one fingerprint with the
least of them, and the links of near fingerprints. The bands add what SimHash misses: at a similarity of 0.8 about ten bits
of 64 differ. Fingerprints within 4 bits with sets below SIMILAR are told apart by the comparison of the sets.

Texts with equal sets are one class, so copies never meet pair by pair. Candidates are found twice: first each class
with the least of its bucket, then all pairs of a bucket that the links found so far have not joined; so a large group of
near copies does not give the square of its size, and no pair of a bucket is left out. The second time the sets travel to
the buckets, at most two blocks of one at a time, and only spanning edges come back.

Cases: words end at ASCII white space, A-Z are lower-cased; a text of fewer than five words is one shingle; texts without
words (null, empty) are one class that links with no other; ids may repeat or be null, since each row is judged by its own
text; an empty table gives an empty result. Shingles and classes are known by 64 bits: two unlike ones agree with
probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewright.llm import simhash
from lanewright.llm.blocks import bucket_pairs, dealt_buckets, whole_buckets
from lanewright.llm.components import connected_components, star_edges
from lanewright.llm.workers import tidy
from lanewright.scratch import join_checked, materialise

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 32, 6
SEED = 71
PIECE = 2048
_draw = np.random.default_rng(SEED)
_odd = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_flip = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of a text's shingles, each once and in order."""
    words = (text or "").encode().lower().split()
    n = max(1, len(words) - width + 1) if words else 0
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + width])) for i in range(n)], np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for each band of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), PIECE):
        part = (hashes[lo : lo + PIECE, None] ^ _flip) * _odd
        np.minimum(least, part.min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]


def _described(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, th, cls, n, keys, fp): the text's hash, its set's hash, size and band keys, and its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, n, keys, fp = [], [], [], []
            for t in b.column("text"):
                s = shingle_set(t.as_py())
                fp.append(simhash.signed(simhash.fingerprint(t.as_py())))
                cls.append(xxhash.xxh64_intdigest(s.tobytes()))
                n.append(len(s))
                keys.append(np.array(band_keys(s) if len(s) else [], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("th"), pa.array(np.array(cls, np.uint64).view(np.int64)), pa.array(n, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(fp, pa.int64()),
            ], names=["doc_id", "th", "cls", "n", "keys", "fp"])

    src = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return src.mapInArrow(tidy(run), f"doc_id {dict(src.dtypes)['doc_id']}, th long, cls long, n int, keys array<long>, fp long")


def fingerprint_pairs(described: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (a, b) of classes that SimHash links: those of a fingerprint with its least, and the least ones of near fingerprints."""
    of = materialise(described.filter("n > 0").select("fp", "cls").distinct(), "similar-fingerprints")
    least = materialise(of.groupBy("fp").agg(F.min("cls").alias("rep"), F.count("*").alias("m")), "similar-least-fingerprints")
    same = join_checked(of, least.filter("m > 1").select("fp", "rep"), "fp").select(F.col("rep").alias("a"), F.col("cls").alias("b"))
    return same.unionByName(simhash.linked(least.select("fp", "rep"), max_bits)).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _least_pairs(rows: DataFrame) -> DataFrame:
    """Each class (key, cls, n) with the least one of its bucket."""
    low = materialise(rows.groupBy("key").agg(F.min("cls").alias("a"), F.count("*").alias("m")).filter("m > 1").select("key", "a"), "similar-least")
    return join_checked(rows, low, "key").select("a", F.col("cls").alias("b")).filter("a <> b").distinct()


def _other_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Spanning edges (a, b) between rows (key, cls, n, component) of a bucket that differ in component, by whole sets.

    Pairs are compared where they meet and never written down; what a bucket has joined already isn't compared again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, end in whole_buckets(batches, ["key"], rows=20_000):
            cls, n, comp, lo, hi, side = (t.column(c).to_numpy() for c in ("cls", "n", "component", "lo", "hi", "side"))
            held = [x.values.to_numpy() for x in t.column("s")]
            root = np.unique(comp, return_inverse=True)[1]
            us, vs = [], []
            for i, j in bucket_pairs(end, lo, hi, side):
                ok = (root[i] != root[j]) & (np.minimum(n[i], n[j]) >= SIMILAR * np.maximum(n[i], n[j]) - 1e-9)
                for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                    if root[x] == root[y]:
                        continue
                    shared = len(np.intersect1d(held[x], held[y], assume_unique=True))
                    if shared >= SIMILAR * (n[x] + n[y] - shared) - 1e-9:
                        us.append(x)
                        vs.append(y)
                        root[root == root[y]] = root[x]
            if us:
                a, b = star_edges(cls, np.array(us), np.array(vs))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    several = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    rows = join_checked(rows, materialise(several, "similar-several"), "key", "left_semi")
    rows = materialise(rows, "similar-left")
    rows = rows.join(sets(rows.select("cls").distinct()), "cls")
    return dealt_buckets(rows, ["key"], "cls").mapInArrow(tidy(run), "a long, b long").distinct()


def _sets(wanted: DataFrame, described: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (cls, s): the sets of wanted classes, each from one of its texts."""
    wanted = materialise(wanted, "similar-wanted")
    one = join_checked(described.select("doc_id", "th", "cls"), wanted, "cls").groupBy("cls").agg(F.min(F.struct("doc_id", "th")).alias("r"))
    one = materialise(one.select("cls", F.col("r.doc_id").alias("_id"), F.col("r.th").alias("_th")), "similar-texts")
    found = join_checked(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), one, (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py()).view(np.int64) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array(sets, pa.list_(pa.int64()))], names=["cls", "s"])

    return materialise(found.select("cls", "text").mapInArrow(tidy(run), "cls long, s array<long>").groupBy("cls").agg(F.any_value("s").alias("s")), "similar-sets")


def _alike(pairs: DataFrame, sets) -> DataFrame:
    """The pairs of classes whose whole sets agree to SIMILAR or more."""
    pairs = materialise(pairs, "similar-pairs")
    s = sets(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    both = pairs.join(s.select(F.col("cls").alias("a"), F.col("s").alias("sa")), "a").join(s.select(F.col("cls").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= F.lit(SIMILAR) * (F.size("sa") + F.size("sb") - shared) - 1e-9).select("a", "b")


def similar_groups(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, th, cls, component) for every row of docs; th is the text's hash, component the group's least class."""
    described = materialise(_described(docs), "similar")
    classes = described.filter("n > 0").groupBy("cls").agg(F.any_value("n").alias("n"), F.any_value("keys").alias("keys"))
    rows = materialise(classes.select("cls", "n", F.explode("keys").alias("key")), "similar-keys")

    def sets(wanted: DataFrame) -> DataFrame:
        return _sets(wanted, described, docs)

    first = fingerprint_pairs(described).unionByName(_least_pairs(rows)).distinct()
    edges = materialise(_alike(first, sets), "similar-links")
    comps = materialise(connected_components(edges), "similar-components").withColumnRenamed("node", "cls")
    rows = materialise(join_checked(rows, comps, "cls", "left").withColumn("component", F.coalesce("component", "cls")), "similar-keys")
    edges = edges.unionByName(materialise(_other_links(rows, sets), "similar-links"))
    comps = materialise(connected_components(edges), "similar-components").withColumnRenamed("node", "cls")
    return join_checked(described.select("doc_id", "th", "cls"), comps, "cls", "left").select("doc_id", "th", "cls", F.coalesce("component", "cls").alias("component"))


def drop_similar(docs: DataFrame) -> DataFrame:
    """One row of each group stays: that of the least id (rows without an id come last), by text hash where ids repeat."""
    groups = materialise(similar_groups(docs), "similar-groups")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    several = groups.groupBy("component").agg(F.min(key).alias("k"), F.count("*").alias("n")).filter("n > 1")
    several = materialise(several.select("component", F.col("k.doc_id").alias("_id"), F.col("k.th").alias("_th")), "similar-several")
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    gone = join_checked(groups, several, "component").filter(~own).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    gone = materialise(gone, "similar-gone")
    again = materialise(groups.groupBy("doc_id", "th").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")), "similar-again")
    docs = docs.withColumn("_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_th"))
    left = join_checked(docs, gone, same, "left_anti")
    if not again.isEmpty():
        first = Window.partitionBy("doc_id", "_key").orderBy("text")
        one = join_checked(left, again, same, "left_semi").withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
        left = join_checked(left, again, same, "left_anti").unionByName(one)
    return left.drop("_key")
