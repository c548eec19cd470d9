"""Keyed tables laid out by key hash: a merge reads and rewrites only the buckets that it touches.

A bucket is a partition folder. Merges find their buckets from the batch's keys, read those folders alone, and replace them by
a dynamic partition overwrite. A merge that fails is run again with the same result: an upsert puts the same values, an
insertion finds its rows there, a deletion finds them gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.operators import store
from lanewright.operators.quality import QualityError
from lanewright.scratch import materialise

BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, mode: str, files: int) -> None:
    deal = [F.col(BUCKET), F.pmod(F.monotonically_increasing_id(), F.lit(files))] if files > 1 else [F.col(BUCKET)]
    df.repartition(*deal).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(path)


def create(df: DataFrame, path: str, keys: list[str], buckets: int, files: int = 1) -> None:
    """Write a table anew; ``files`` tasks share a bucket, for buckets beyond a task's size."""
    _write(df.withColumn(BUCKET, bucket_of(keys, buckets)), path, "static", files)


def read(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """A table, or some of its buckets: the others are pruned before any file is listed for reading."""
    df = spark.read.parquet(path)
    return df if buckets is None else df.filter(F.col(BUCKET).isin(buckets))


def touched(batch: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets of a batch's keys, of ``buckets`` at most."""
    return sorted(r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())


def _merge(path: str, batch: DataFrame, keys: list[str], buckets: int, how, files: int) -> list[int]:
    batch = materialise(batch, "merge-batch")
    if batch.filter(" OR ".join(f"`{k}` IS NULL" for k in keys)).limit(1).count():
        raise QualityError("a batch row lacks a key")
    at = touched(batch, keys, buckets)
    if at:
        old = read(batch.sparkSession, path, at).drop(BUCKET)
        # written apart first: no plan overwrites what it reads
        merged = materialise(how(old, batch, keys).withColumn(BUCKET, bucket_of(keys, buckets)), "merged")
        _write(merged, path, "dynamic", files)
    return at


def upsert(path: str, batch: DataFrame, keys: list[str], buckets: int, files: int = 1) -> list[int]:
    """Batch rows replace or join those of their key; the buckets that were rewritten."""
    return _merge(path, batch, keys, buckets, store.upsert, files)


def insert_absent(path: str, batch: DataFrame, keys: list[str], buckets: int, files: int = 1) -> list[int]:
    """Batch rows whose key is new are added; only their buckets are rewritten."""
    spark, batch = batch.sparkSession, materialise(batch, "insert-batch")
    known = read(spark, path, touched(batch, keys, buckets)).select(*keys)
    return _merge(path, batch.join(known, keys, "left_anti"), keys, buckets, store.insert_absent, files)


def delete_stale(spark: SparkSession, path: str, valid: DataFrame, key: str, keys: list[str], buckets: int, files: int = 1) -> list[int]:
    """Rows whose ``key`` is not valid go; only buckets with such rows are rewritten. An empty valid set is refused."""
    if valid.isEmpty():
        raise QualityError("the set of valid keys is empty")
    ok = materialise(valid.select(key).distinct(), "valid-keys")
    stale = read(spark, path).select(key, BUCKET).join(ok, key, "left_anti")
    at = sorted(r[0] for r in stale.select(BUCKET).distinct().collect())
    if at:
        kept = materialise(read(spark, path, at).join(ok, key, "left_semi"), "kept")
        left = sorted(r[0] for r in kept.select(BUCKET).distinct().collect())
        _write(kept, path, "dynamic", files)
        for b in set(at) - set(left):  # nothing is left of these, so no overwrite names them
            store.remove(spark, f"{path}/{BUCKET}={b}")
    return at
