"""Registered queries of streams over readings that land late, out of order and again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions import timeslot as ts
from lanewright.operators import store
from lanewright.plans import inputs as inp
from lanewright.plans.catalog import query, r6, slot_sql
from lanewright.scratch import materialise, scratch_path
from lanewright.sources import selection
from lanewright.streaming import streams

LATE = "2 days"

# a reading lands with the others of its eight days; every tenth one landing later, and some once more after that
LANDED = """landed AS (SELECT CAST(user_id AS VARCHAR) AS segment_id, value AS speed, ts AS observed_at, least(3, (day(ts) - 1) // 8) + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END + again AS b
 FROM events, (VALUES (0), (1)) r(again) WHERE again = 0 OR event_id % 12 = 5)"""


def landings(spark: SparkSession, d: str):
    """The readings in the order of their landing, one folder that grows."""
    e = inp.table(spark, d, "events")
    b = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8)) + (F.col("event_id") % 10 == 3).cast("int")
    r = e.select(F.col("user_id").cast("string").alias("segment_id"), F.col("value").alias("speed"), F.col("ts").cast("timestamp").alias("observed_at"), "event_id", b.cast("int").alias("b"))
    r = r.unionByName(r.filter("event_id % 12 = 5").withColumn("b", F.col("b") + 1)).drop("event_id")
    r, path = materialise(r, "landings"), scratch_path(spark, "landed")
    for k in range(6):
        r.filter(F.col("b") == k).drop("b").write.mode("append").parquet(path)
        yield path


@query(f"""WITH {LANDED}, first AS (SELECT segment_id, {slot_sql('observed_at')} AS time, observed_at, min(b) AS b, min(speed) AS speed FROM landed GROUP BY ALL)
 SELECT segment_id, time, r.avg AS avg, r.n AS count, r.t AS last_sample_at, r.late AS late FROM (SELECT segment_id, time, list_reduce(list({{'avg': round_even(speed, 0), 'n': CAST(1 AS BIGINT), 't': observed_at, 'v': speed, 'late': CAST(0 AS BIGINT)}} ORDER BY b, observed_at),
 lambda a, x: {{'avg': round_even(a.avg + (x.v - a.avg) / least(a.n + 1, 10), 0), 'n': a.n + 1, 't': greatest(a.t, x.t), 'v': x.v, 'late': a.late + CASE WHEN x.t < a.t THEN 1 ELSE 0 END}}) AS r FROM first GROUP BY segment_id, time)""")
def stream_running_mean_late(spark: SparkSession, d: str) -> DataFrame:
    """The keyed state over six landings, each taken by a run of its own from the same checkpoint."""
    table, log = scratch_path(spark, "late-means"), scratch_path(spark, "late-means-log")
    for path in landings(spark, d):
        s = streams.read_landed(spark, path, streams.READINGS)
        values = s.select("segment_id", ts.slot(F.col("observed_at")).alias("time"), F.col("speed").alias("value"), F.col("observed_at").alias("last_sample_at"))
        streams.fold_means(values, table, log).awaitTermination()
    return store.newest_of_batches(spark, table, ["segment_id", "time"])


@query(f"""WITH {LANDED}, marks AS (SELECT b, (SELECT date_trunc('millisecond', max(observed_at)) FROM landed x WHERE x.b < y.b) - INTERVAL {LATE} AS mark FROM (SELECT DISTINCT b FROM landed) y),
 marked AS (SELECT landed.*, time_bucket(INTERVAL 30 MINUTE, observed_at) AS bucket, coalesce(observed_at <= mark, false) AS late FROM landed JOIN marks USING (b)),
 once AS (SELECT *, row_number() OVER (PARTITION BY segment_id, observed_at ORDER BY b) AS k FROM marked WHERE NOT late)
 SELECT 'closed' AS kind, bucket, segment_id, count(*) AS readings, round(avg(speed), 6) AS speed FROM once WHERE k = 1 AND bucket + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(observed_at)) - INTERVAL {LATE} FROM landed) GROUP BY ALL
 UNION ALL SELECT 'late', bucket, segment_id, count(*), round(avg(speed), 6) FROM marked WHERE late GROUP BY ALL UNION ALL SELECT 'repeated', bucket, segment_id, count(*), round(avg(speed), 6) FROM once WHERE k > 1 GROUP BY ALL""")
def stream_lateness(spark: SparkSession, d: str) -> DataFrame:
    """Windows that closed, rows behind the watermark and rows that came again, over six landings."""
    windows, routed = scratch_path(spark, "closed"), scratch_path(spark, "routed")
    logs = [scratch_path(spark, "closed-log"), scratch_path(spark, "routed-log")]
    for path in landings(spark, d):
        streams.closed_windows(streams.read_landed(spark, path, streams.READINGS), windows, logs[0], ["segment_id"], late=LATE).awaitTermination()
        streams.route_late(streams.read_landed(spark, path, streams.READINGS), routed, logs[1], late=LATE).awaitTermination()
    rows = store.batches(spark, f"{routed}/rows").withColumn("bucket", F.window("observed_at", "30 minutes")["start"])
    closed = store.batches(spark, windows).select(F.lit("closed").alias("kind"), "bucket", "segment_id", "readings", r6("speed"))
    how = [F.count("*").alias("readings"), F.round(F.avg("speed"), 6).alias("speed")]
    late = rows.filter("late").groupBy(F.lit("late").alias("kind"), "bucket", "segment_id").agg(*how)
    again = rows.filter("NOT late").groupBy("segment_id", "observed_at", "bucket").agg(F.count("*").alias("k"), F.min("speed").alias("speed")).filter("k > 1")
    again = again.groupBy(F.lit("repeated").alias("kind"), "bucket", "segment_id").agg(F.sum(F.col("k") - 1).alias("readings"), F.round(F.sum((F.col("k") - 1) * F.col("speed")) / F.sum(F.col("k") - 1), 6).alias("speed"))
    return closed.unionByName(late).unionByName(again)


LOOKS = ["2024-01-10", "2024-01-20", "2024-02-10"]


@query(f"""WITH r AS (SELECT CAST(user_id AS VARCHAR) AS segment_id, ts AS observed_at FROM events), start AS (SELECT max(observed_at) - INTERVAL 6 HOUR AS since FROM r WHERE observed_at < TIMESTAMP '{LOOKS[0]}')
 SELECT segment_id, CAST(observed_at AS DATE) AS date, count(*) AS readings FROM r, start WHERE observed_at > since GROUP BY ALL""")
def ingest_exactly_once(spark: SparkSession, d: str) -> DataFrame:
    """Three looks at a growing source; the second fails after its rows are written and before the marker, and is tried again."""
    r = inp.readings(spark, d).withColumn("observed_at", F.col("observed_at").cast("timestamp"))
    out, marker = scratch_path(spark, "taken"), scratch_path(spark, "taken-marker")
    for look, end in enumerate(LOOKS):
        for fails in (look == 1, False):

            def sink(new: DataFrame, number: int, fails: bool = fails) -> None:
                store.write_batch(new, out, number)
                if fails:
                    raise InterruptedError

            try:
                selection.take_new(spark, r.filter(F.col("observed_at") < end), "observed_at", marker, sink)
            except InterruptedError:
                continue
    return store.batches(spark, out).groupBy("segment_id", F.to_date("observed_at").alias("date")).agg(F.count("*").alias("readings"))
