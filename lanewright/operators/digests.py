"""Digests of tables by SHA-256 in a tree: rows, ranges of hashed keys, the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 256


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row: each value by length and text, so no two rows read alike, and null unlike any text."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def key_range(keys: list[str], ranges: int) -> Column:
    """A key's range, 0 .. ranges - 1: equal shares of the first 28 bits of its digest, alike in every table."""
    return F.shiftright(F.conv(F.substring(row_digest(keys), 1, 7), 16, 10).cast("long") * ranges, 28).cast("int")


def range_digests(df: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(range, rows, digest) of the ranges that have rows; a digest is that of the range's row digests in order.

    ``columns`` are compared, ``keys`` say where a row belongs. Repeated rows count as often as they come. A range is one
    group of 64 bytes a row, so take ranges for at most some hundred thousand rows each.
    """
    d = df.select(key_range(keys, ranges).alias("range"), row_digest(columns).alias("d"))
    return d.groupBy("range").agg(F.count("*").alias("rows"), F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("digest"))


def table_digest(by_range: DataFrame) -> DataFrame:
    """One row (rows, digest): the digest of the ranges' digests in order, each with its number."""
    lines = F.array_sort(F.collect_list(F.struct("range", "digest")))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x["range"].cast("string"), F.lit(":"), x["digest"])), "|")
    return by_range.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sha2(text, 256).alias("digest"))


def differing_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """(range, rows_a, rows_b) where two tables of range digests disagree; a range that one lacks has no rows there."""
    j = a.select("range", F.col("rows").alias("rows_a"), F.col("digest").alias("_a")).join(b.select("range", F.col("rows").alias("rows_b"), F.col("digest").alias("_b")), "range", "full_outer")
    return j.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("range", F.coalesce("rows_a", F.lit(0)).alias("rows_a"), F.coalesce("rows_b", F.lit(0)).alias("rows_b"))


def version_of(df: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> str:
    """A table as one word, ``rows-digest``."""
    t = table_digest(range_digests(df, keys, columns, ranges)).first()
    return f"{t.rows}-{t.digest}"
