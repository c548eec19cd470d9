"""Which inputs to read: newer than a marker, complete, missing, already done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.operators.quality import QualityError
from lanewright.operators.store import batches, write_batch


def newer_than(df: DataFrame, column: str, marker: Column) -> DataFrame:
    return df.filter(F.col(column) > marker)


def last_take(spark: SparkSession, marker_path: str) -> tuple[str | None, int]:
    """The newest marker and the number of the next take."""
    marked = batches(spark, marker_path)
    last = None if marked is None else marked.orderBy(F.desc("batch")).first()  # one row a take
    return (None, 0) if last is None else (last.marker, last.batch + 1)


def take_new(spark: SparkSession, source: DataFrame, column: str, marker_path: str, sink, first_look_back: str = "6 hours", now: str | None = None) -> bool:
    """Rows past the stored marker go to ``sink(rows, number)``; the marker moves only after it returned. False where there are none.

    The number counts the takes that were marked, so a take that failed after its sink had written comes again under the
    same number, and a sink that writes by number (``store.write_batch``) replaces what it wrote. Markers are kept, one a
    take, so none is ever overwritten. Without a marker the look-back before ``now`` (the newest row if not given) is taken.
    """
    kept, number = last_take(spark, marker_path)
    if kept is not None:
        after = F.lit(kept).cast("timestamp")
    else:
        newest = F.lit(now).cast("timestamp") if now else F.lit(source.agg(F.max(column)).first()[0])
        after = newest - F.expr(f"INTERVAL {first_look_back}")
    new = newer_than(source, column, after)
    top = new.agg(F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if top is None:
        return False
    # what lands meanwhile is past the marker and waits for the next take
    sink(new.filter(F.col(column) <= F.lit(top).cast("timestamp")), number)
    write_batch(spark.createDataFrame([(top,)], "marker string").coalesce(1), marker_path, number)
    return True


def latest_partitions(dates: DataFrame, n: int) -> DataFrame:
    """The newest n dates, which must be distinct in the input, enough and without a gap."""
    if not dates.groupBy("date").count().filter("count > 1").isEmpty():
        raise QualityError("a date comes more than once")
    top = dates.select("date").orderBy(F.desc("date")).limit(n)
    s = top.agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("span")).first()
    if s.n < n or s.span != n:
        raise QualityError(f"{n} dates without a gap are needed; found {s.n} from {s.a} to {s.b}")
    return top


def latest_complete(versions: DataFrame) -> DataFrame:
    """(version, complete, ...) to the rows of the newest complete version."""
    top = versions.filter("complete").agg(F.max("version").alias("version"))
    return versions.join(top, "version", "left_semi")


def complete_months(manifest: DataFrame, kinds: DataFrame) -> DataFrame:
    """(month, kind, path, done) and the kinds needed to (month, paths, missing, ready): ready when every kind is done."""
    want = manifest.select("month").distinct().crossJoin(kinds.select("kind").distinct())  # months by kinds
    done = manifest.filter("done").select("month", "kind", "path").withColumn("has", F.lit(True))
    g = want.join(done, ["month", "kind"], "left").groupBy("month")
    out = g.agg(F.array_sort(F.collect_set("path")).alias("paths"), F.array_sort(F.collect_set(F.when(F.col("has").isNull(), F.col("kind")))).alias("missing"))
    return out.withColumn("ready", F.size("missing") == 0)


def missing_inputs(landed: DataFrame, as_of: Column, kinds: DataFrame, lags: tuple[int, int] = (2, 5)) -> DataFrame:
    """(month, kind) of the service months from lags[0] to lags[1] months ago that have not landed."""
    month = F.date_format(F.add_months(as_of, -F.col("lag")), "yyyy-MM")
    months = kinds.sparkSession.range(lags[0], lags[1] + 1).select(F.col("id").cast("int").alias("lag")).select(month.alias("month"))
    want = months.crossJoin(F.broadcast(kinds.select("kind")))  # a few months by a few kinds
    return want.join(landed.select("month", "kind"), ["month", "kind"], "left_anti")


def not_done(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return wanted.join(done.select(key), key, "left_anti")
