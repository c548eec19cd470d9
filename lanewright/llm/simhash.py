"""SimHash near-duplicates, candidates by pigeonring filtering.

The 64 bits form a ring of SEGMENTS segments. If two fingerprints differ in at most ``max_bits`` bits, some segment
starts a chain in which the first l segments together differ in at most l * max_bits / SEGMENTS bits, for every l. With 5
segments and 4 bits such a chain starts with an equal segment, has at most one differing bit in two segments and at most
two in three. So of four parts of its second and third segments at least two are equal: the equal first segment and
each two of those parts form the candidate keys (30 per fingerprint, about 26 bits each). Candidates are pruned by the
whole chain's budgets before the full Hamming check.

Equal fingerprints are one class, so exact copies never meet pair by pair, and buckets give back spanning edges only.

Cases: null and empty texts have fingerprint zero and are linked like others; a null id takes no part in linking and
gets its fingerprint's component; repeated rows are returned as often as they come; texts of any length are hashed in
pieces; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.blocks import bucket_pairs, dealt_buckets, whole_buckets
from lanewright.llm.components import connected_components, star_edges
from lanewright.llm.workers import tidy
from lanewright.scratch import join_checked, materialise

SHINGLE = 4
HASH_SEED = 42
SEGMENTS = 5
PARTS, EQUAL_PARTS = 4, 2
PIECE = 200_000


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of word shingles; A-Z are lower-cased and words end at ASCII white space only."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    n = max(1, len(words) - width + 1)
    start, stop = start[:n].tolist(), stop[min(width, len(words)) - 1 :].tolist()
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, n, PIECE):
        h = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(start[lo : lo + PIECE], stop[lo : lo + PIECE], strict=True)], np.uint64)
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * bits > n).tolist())


def segment_masks() -> list[int]:
    edges = [64 * k // SEGMENTS for k in range(SEGMENTS + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def key_masks() -> list[tuple[int, int]]:
    """(first segment of the chain, mask of the bits that must agree)."""
    segments, out = segment_masks(), []
    for k in range(SEGMENTS):
        following = [i for s in (segments[(k + 1) % SEGMENTS], segments[(k + 2) % SEGMENTS]) for i in range(64) if s >> i & 1]
        parts = [sum(1 << i for i in p.tolist()) for p in np.array_split(np.array(following), PARTS)]
        out += [(k, segments[k] | sum(c)) for c in combinations(parts, EQUAL_PARTS)]
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [signed(fingerprint(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(tidy(run), f"doc_id {src.dtypes[0][1]}, fp long")


def linked(classes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Spanning edges (a, b) between the ``rep`` of fingerprints within ``max_bits`` bits; classes: (fp, rep)."""
    if max_bits > SEGMENTS - 1:
        raise ValueError("the keys hold for fewer differing bits than segments")
    masks = key_masks()
    rows = classes.select("fp", "rep", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, (_, m) in enumerate(masks)
    ])).alias("s")).select(F.col("s.k").alias("k"), F.col("s.key").alias("key"), "fp", "rep")
    segments = np.array(segment_masks(), np.uint64)
    first = np.array([s for s, _ in masks])
    budget = [l * max_bits // SEGMENTS for l in range(1, SEGMENTS + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, end in whole_buckets(batches, ["k", "key"]):
            fp = t.column("fp").to_numpy().view(np.uint64)
            rep, k, lo, hi, side = (t.column(c).to_numpy() for c in ("rep", "k", "lo", "hi", "side"))
            us, vs = [], []
            for i, j in bucket_pairs(end, lo, hi, side):
                x, s, apart = fp[i] ^ fp[j], first[k[i]], 0
                for l in range(SEGMENTS):
                    apart = apart + np.bitwise_count(x & segments[(s + l) % SEGMENTS]).astype(np.int64)
                    ok = apart <= budget[l]
                    i, j, x, s, apart = i[ok], j[ok], x[ok], s[ok], apart[ok]
                ok = np.bitwise_count(x) <= max_bits
                us.append(i[ok])
                vs.append(j[ok])
            if us and sum(map(len, us)):
                a, b = star_edges(rep, np.concatenate(us), np.concatenate(vs))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt_buckets(rows, ["k", "key"], "fp").mapInArrow(tidy(run), "a long, b long")


def near_duplicates(docs: DataFrame, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp, component_id)."""
    fps = materialise(fingerprints(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), "simhash")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found = connected_components(linked(classes.filter("rep IS NOT NULL"), max_bits))
    classes = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, max_bits: int = 4) -> DataFrame:
    """One row of each group stays: that of the least id (rows without an id come last), by text hash where ids repeat.

    Rows are told apart by a number of their own, so each is judged by its own text whatever its id.
    """
    rows = materialise(docs.withColumn("_uid", F.monotonically_increasing_id()), "simhash-rows")
    groups = near_duplicates(rows, max_bits, "_uid").select(F.col("doc_id").alias("_uid"), F.col("component_id").alias("_group"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("th"), "_uid")
    of_row = rows.select("_uid", key.alias("_key")).join(groups, "_uid")
    kept = of_row.groupBy("_group").agg(F.min("_key").alias("k")).select("k._uid")
    return join_checked(rows, materialise(kept, "simhash-kept"), "_uid", "left_semi").select(*docs.columns)
