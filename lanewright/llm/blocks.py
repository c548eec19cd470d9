"""Comparing the members of buckets within bounded tasks.

A bucket (rows that agree in the key columns) with more than ``block_rows`` rows is cut into blocks, and each pair of
blocks becomes a bucket of its own, so no task ever holds more than two blocks of one bucket and every pair still meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.scratch import join_checked, materialise


def dealt_buckets(rows: DataFrame, keys: list[str], id_col: str, block_rows: int = 1024) -> DataFrame:
    """Adds lo, hi (block numbers) and side, deals the rows out by bucket and sorts each task's rows by bucket."""
    hot = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
    hot = materialise(hot.select(*keys, F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), "hot-buckets")
    if hot.isEmpty():
        rows = rows.withColumns({"lo": F.lit(0), "hi": F.lit(0), "side": F.lit(0)})
    else:
        rows = join_checked(rows, hot, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        rows = rows.withColumn("own", F.pmod(F.xxhash64(id_col), F.col("blocks").cast("long")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.withColumns({
            "lo": F.least("own", "other"), "hi": F.greatest("own", "other"),
            "side": (F.col("own") > F.col("other")).cast("int"),
        }).drop("blocks", "own", "other")
    deal = [*keys, "lo", "hi"]
    return rows.repartition(*deal).sortWithinPartitions(*deal)


def whole_buckets(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 300_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole buckets, about ``rows`` rows each, with every row's bucket end (as a position in the table)."""

    def cut(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in [*keys, "lo", "hi"]:
            x = t.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def ends(starts: np.ndarray, n: int) -> np.ndarray:
        sizes = np.diff(np.append(starts, n))
        return np.repeat(starts + sizes, sizes)

    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held)
            starts = cut(t)
            last = int(starts[-1])
            if last:
                yield t.slice(0, last), ends(starts[:-1], last)
            rest = t.slice(last).combine_chunks()
            held, n = rest.to_batches(), rest.num_rows
    if n:
        t = pa.Table.from_batches(held)
        yield t, ends(cut(t), n)


def bucket_pairs(end: np.ndarray, lo: np.ndarray, hi: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Position pairs (i, j) within buckets, a stretch at a time; rows of two different blocks meet only across sides."""
    i, d = np.arange(len(end)), 0
    while True:
        d += 1
        i = i[i + d < end[i]]
        if not len(i):
            return
        j = i + d
        keep = (lo[i] == hi[i]) | (side[i] != side[j])
        yield i[keep], j[keep]
