"""Sharding by sampled splitters.

Records are ordered by (hash of the text, id). A size-weighted key sample gives quantile boundaries; records are range-
partitioned between them; ranges that turn out overfull are subdivided by a second hash; the measured ranges are then
cut into shards at equal shares of the bytes, so shard sizes differ by about one record.

Cases: a null text has no bytes and a size of ``OVERHEAD``; null ids sort first; repeated rows are kept and each has a
slot of its own (which of two equal rows gets which slot is not defined); an empty table gives an empty result; columns
other than the two named ones are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewright.scratch import materialise

#: Bytes that a record takes beside its text.
OVERHEAD = 16
#: Expected number of sampled keys; this bounds what the driver sees.
SAMPLE_KEYS = 20_000
SAMPLE_SEED = 17


def sample_splitters(keyed: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Quantile boundaries of ``okey`` from a sample where a record is drawn in proportion to its size.

    A record of size s is drawn s * SAMPLE_KEYS / total times in expectation (whole draws plus a seeded chance for the
    rest), so about SAMPLE_KEYS keys reach the driver at any input size.
    """
    rate = SAMPLE_KEYS / max(total, 1)
    u = (F.shiftrightunsigned(F.xxhash64("okey", "doc_id", F.lit(SAMPLE_SEED)), 11) / F.lit(float(1 << 53)))
    draws = F.floor(F.col("size") * F.lit(rate) + u).cast("long")
    rows = keyed.select("okey", draws.alias("draws")).filter("draws > 0").groupBy("okey").agg(F.sum("draws").alias("draws")).collect()
    if not rows:
        return np.array([], dtype=np.int64)
    keys = np.array([r.okey for r in rows], dtype=np.int64)
    order = np.argsort(keys)
    weight = np.cumsum(np.array([r.draws for r in rows], dtype=np.float64)[order])
    at = np.searchsorted(weight, np.arange(1, ranges) * weight[-1] / ranges)
    return np.unique(keys[order][np.minimum(at, len(keys) - 1)])


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", ranges_per_shard: int = 8, cell_rows: int = 200_000) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard, slot."""
    text = F.col(text_col)
    body = F.coalesce(text.cast("binary"), F.lit("").cast("binary"))
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(text).alias("okey"),
    )
    keyed = materialise(keyed, "shard-keys")
    total, rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    splitters = sample_splitters(keyed, total, shards * ranges_per_shard)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    ranged = keyed.withColumn("rng", range_of("okey"))
    # An overfull range is dealt out by a second hash of the id into cells of a bounded share.
    target = max(1, min(cell_rows, rows // (shards * ranges_per_shard) + 1))
    fill = ranged.groupBy("rng").agg(F.count("*").alias("n"))
    fill = fill.select("rng", F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(2.0 * target))).cast("int").alias("parts"))
    # one row per range: at most shards * ranges_per_shard rows
    ranged = ranged.join(F.broadcast(fill), "rng").withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "okey", F.lit(5)), F.col("parts").cast("long"))
    ).drop("parts")
    cells = ranged.groupBy("rng", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    before = Window.orderBy("rng", "cell").rowsBetween(Window.unboundedPreceding, -1)
    # the cell table has a row per cell, not per record; only its running sums are in one place
    cells = cells.select(
        "rng", "cell",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
    )
    inside = Window.partitionBy("rng", "cell").orderBy("okey", F.col("doc_id").asc_nulls_first())
    placed = ranged.select(
        "rng", "cell", "doc_id", "size", "text_crc32",
        F.row_number().over(inside).alias("k"),
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )
    placed = placed.join(cells, ["rng", "cell"]).select(
        "doc_id", "size", "text_crc32",
        (F.col("n0") + F.col("k") - 1).alias("at"),
        F.least(F.lit(shards - 1), F.floor((F.col("b0") + F.col("upto") - F.col("size") / 2) * F.lit(shards) / F.lit(max(total, 1)))).cast("int").alias("shard"),
    )
    placed = materialise(placed, "shard-placed")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).cast("long").alias("slot")
    )
