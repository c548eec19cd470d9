"""Shared scratch tables and size-checked joins.

Scratch tables go to the folder named by ``spark.checkpoint.dir``; every executor and the driver see it,
so a table outlives any executor. Only where that setting is absent (local tests) is a folder made here.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many narrow rows (ids, numbers, short keys: some tens of bytes each) may be broadcast.
BROADCAST_ROWS = 500_000

_local_folder: list[str] = []
_written: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_folder:
        _local_folder.append("file://" + tempfile.mkdtemp(prefix="lanewright-"))
    return _local_folder[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _delete_from(spark: SparkSession, start: int) -> None:
    while len(_written) > start:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this session wrote; call it when the results that were built on it have been stored."""
    _delete_from(spark, 0)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end, also after an error; no frame built on them may leave the block."""
    start = len(_written)
    try:
        yield
    finally:
        _delete_from(spark, start)


def leaves_no_scratch(job: Callable) -> Callable:
    """For jobs (spark, ...) that store their result and return nothing that rests on scratch tables of theirs."""

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch_scope(spark):
            return job(spark, *args, **kwargs)

    return run


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: the lineage is cut there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_checked(big: DataFrame, side: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``side`` broadcast only when it was counted and has at most ``rows`` rows.

    A larger side is joined by shuffle, where adaptive execution splits skewed keys. ``side`` is evaluated for the
    count, so pass a materialised or cheap frame.
    """
    small = side.limit(rows + 1).count() <= rows
    return big.join(F.broadcast(side) if small else side, on, how)
