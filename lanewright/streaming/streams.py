"""Structured Streaming forms: event-time windows, late and repeated readings, and the running mean as keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lanewright.operators import store, traveltime

#: Times of a key's last arrivals that its state keeps, to know repeats by.
REMEMBERED = 32
#: Micro-batches after which all states of a keyed mean are written as one.
WHOLE_EVERY = 8
READINGS = "segment_id string, speed double, observed_at timestamp"


def read_landed(spark: SparkSession, path: str, schema=READINGS, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder (or one file); with a checkpoint each is taken once."""
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return r.parquet(path)
    folder, _, name = path.rpartition("/")  # file streams watch folders
    return r.option("pathGlobFilter", name).parquet(folder)


def window_means(readings: DataFrame, late: str = "6 hours", minutes: int = 30) -> DataFrame:
    """Mean speed and newest time by segment and half hour; readings later than ``late`` are dropped."""
    g = readings.withWatermark("observed_at", late).groupBy(F.window("observed_at", f"{minutes} minutes"), "segment_id")
    return g.agg(F.avg("speed").alias("speed"), F.max("observed_at").alias("last_observed_at"), F.count("*").alias("readings")).select(F.col("window.start").alias("bucket"), "segment_id", "speed", "last_observed_at", "readings")


def drop_repeats(readings: DataFrame, keys: list[str], at: str = "observed_at", late: str = "6 hours") -> DataFrame:
    """A reading that comes again (same keys and time) within the watermark counts once."""
    return readings.withWatermark(at, late).dropDuplicatesWithinWatermark([*keys, at])


def land_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None):
    """Each micro-batch as a folder of ``path`` under its number: one that is tried again replaces itself.

    What has landed is taken and the stream ends, or it goes on at the given interval.
    """
    q = stream.writeStream.foreachBatch(lambda batch, n: store.write_batch(batch, path, n)).outputMode(mode).option("checkpointLocation", checkpoint)
    return (q.trigger(processingTime=every) if every else q.trigger(availableNow=True)).start()


class _Mean(StatefulProcessor):
    """One key's running mean: (avg, count, newest time, late samples, times of the last arrivals)."""

    def __init__(self, keys: list[str], window: int, remembered: int, ttl_ms: int | None):
        self.keys, self.window, self.remembered, self.ttl_ms = keys, window, remembered, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("mean", "avg double, count long, newest long, late long, arrived array<long>", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.state.get()
        avg, count, newest, late, arrived = old if old else (0.0, 0, None, 0, [])
        arrived = list(arrived or [])
        for t, v in sorted({(r.t, r.v) for r in rows}):
            if t in arrived:
                continue
            # Python's round is half to even, as is the rounding of the batch form
            avg = float(round(avg + (v - avg) / min(count + 1, self.window))) if count else float(round(v))
            count, late = count + 1, late + (newest is not None and t < newest)
            newest = t if newest is None else max(newest, t)
            arrived = [*arrived, t][-self.remembered :]
        self.state.update((avg, count, newest, late, arrived))
        yield Row(**dict(zip(self.keys, key, strict=True)), avg=avg, count=count, newest=newest, late=late)

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, on disk and checkpointed by what changed."""
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def running_means(values: DataFrame, keys: list[str] = traveltime.READING_KEYS, window: int = traveltime.SMOOTHING, remembered: int = REMEMBERED, ttl: timedelta | None = None) -> DataFrame:
    """(keys, value, last_sample_at) stream to (keys, avg, count, last_sample_at, late): the mean of each key that moved.

    A key's state holds its mean and the times of its last ``remembered`` arrivals. A micro-batch's samples of a key are
    folded in time order; one whose time has arrived before is a repeat and moves nothing, and one that is older than the
    newest counts like any other and is counted as late. A key without samples for ``ttl`` is forgotten; such a stream has
    to run at an interval, for Spark never ends one that watches the clock. Samples without a key part, value or time are
    left out.
    """
    src = values.select(*keys, F.col("value").cast("double").alias("v"), F.unix_micros("last_sample_at").alias("t")).dropna()
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[: len(keys)])
    ms = None if ttl is None else int(ttl.total_seconds() * 1000)
    moved = src.groupBy(*keys).transformWithState(_Mean(keys, window, remembered, ms), f"{ddl}, avg double, count long, newest long, late long", "update", "None" if ttl is None else "ProcessingTime")
    return moved.select(*keys, "avg", "count", F.timestamp_micros("newest").alias("last_sample_at"), "late")


def _folded(samples: DataFrame, old: DataFrame | None, keys: list[str], window: int, remembered: int) -> DataFrame:
    """Samples (keys, v, t) of a micro-batch folded in time order onto the keys' states (avg, count, newest, late, arrived)."""
    g = samples.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("t", "v"))).alias("h"))
    fields = {"avg": "double", "count": "long", "newest": "long", "late": "long", "arrived": "array<long>"}
    if old is None:
        g = g.withColumns({k: F.lit(None).cast(t) for k, t in fields.items()})
    else:
        g = g.join(old.select(*keys, *fields), keys, "left")
    start = F.struct(F.coalesce("avg", F.lit(0.0)).alias("avg"), F.coalesce("count", F.lit(0)).cast("long").alias("count"), F.col("newest").alias("newest"), F.coalesce("late", F.lit(0)).cast("long").alias("late"), F.coalesce("arrived", F.array().cast("array<long>")).alias("arrived"))

    def step(a, x):
        mean = F.when(a["count"] == 0, F.bround(x["v"])).otherwise(F.bround(a["avg"] + (x["v"] - a["avg"]) / F.least(a["count"] + 1, F.lit(window))))
        times = F.when(F.size(a["arrived"]) < remembered, a["arrived"]).otherwise(F.slice(a["arrived"], F.size(a["arrived"]) - remembered + 2, remembered - 1) if remembered > 1 else F.array().cast("array<long>"))
        is_late = F.coalesce(x["t"] < a["newest"], F.lit(False)).cast("long")
        moved = F.struct(mean.alias("avg"), (a["count"] + 1).alias("count"), F.greatest(a["newest"], x["t"]).alias("newest"), (a["late"] + is_late).alias("late"), F.array_append(times, x["t"]).alias("arrived"))
        return F.when(F.array_contains(a["arrived"], x["t"]), a).otherwise(moved)

    return g.select(*keys, F.aggregate("h", start, step).alias("a")).select(*keys, "a.*")


def fold_means(values: DataFrame, path: str, checkpoint: str, every: str | None = None, keys: list[str] = traveltime.READING_KEYS, window: int = traveltime.SMOOTHING, remembered: int = REMEMBERED, ttl: timedelta | None = None):
    """``running_means`` as a keyed table: each micro-batch lands only the keys it moved; read it by ``store.newest_of_batches``.

    A micro-batch is folded by built-in functions onto the newest states of its keys, which lie under ``path/state`` by batch;
    every ``WHOLE_EVERY`` batches all states are written as one, so a batch reads that and the few after it. One that is tried
    again reads only what lies before it and replaces itself. Keys that are forgotten after ``ttl`` need a clock and are kept in
    Spark's own state.
    """
    if ttl is not None:
        with rocksdb_state(values.sparkSession):
            return land_batches(running_means(values, keys, window, remembered, ttl), path, checkpoint, mode="update", every=every)
    src = values.select(*keys, F.col("value").cast("double").alias("v"), F.unix_micros("last_sample_at").alias("t")).dropna()

    def newest(spark: SparkSession, before: int) -> DataFrame | None:
        whole, base = store.batches_before(spark, f"{path}/whole", before), -1
        if whole is not None:
            base = whole.agg(F.max("batch")).first()[0]
            base = -1 if base is None else base
        later = store.batches_before(spark, f"{path}/state", before)
        parts = [] if base < 0 else [whole.filter(F.col("batch") == base)]
        parts += [] if later is None else [later.filter(F.col("batch") > base)]
        if not parts:
            return None
        rows = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
        rest = [c for c in rows.columns if c not in (*keys, "batch")]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")

    def land(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        store.write_batch(_folded(batch, newest(spark, n), keys, window, remembered), f"{path}/state", n)
        moved = spark.read.parquet(f"{path}/state/batch={n}").select(*keys, "avg", "count", F.timestamp_micros("newest").alias("last_sample_at"), "late")
        if n and n % WHOLE_EVERY == 0:
            store.write_batch(newest(spark, n + 1), f"{path}/whole", n)
        store.write_batch(moved, path, n)

    q = src.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (q.trigger(processingTime=every) if every else q.trigger(availableNow=True)).start()


def route_late(readings: DataFrame, path: str, checkpoint: str, late: str = "6 hours", at: str = "observed_at"):
    """Every row lands under ``path/rows`` with ``late``: whether it is behind the watermark, so what windows drop is kept.

    The watermark is that of Structured Streaming over the same micro-batches: the newest time of all earlier ones, to the
    millisecond, less ``late``; a row at or before it, or without a time, is late. The newest times lie under ``path/seen``.
    """

    def land(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        seen = store.batches_before(spark, f"{path}/seen", n)
        top = None if seen is None else seen.agg(F.date_trunc("millisecond", F.max("newest"))).first()[0]
        mark = F.lit(top).cast("timestamp") - F.expr(f"INTERVAL {late}")
        store.write_batch(batch.withColumn("late", F.coalesce(F.col(at) <= mark, F.col(at).isNull())), f"{path}/rows", n)
        store.write_batch(batch.agg(F.max(at).alias("newest")), f"{path}/seen", n)

    return readings.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closed_windows(readings: DataFrame, path: str, checkpoint: str, keys: list[str], late: str = "6 hours", minutes: int = 30):
    """Windows as they close: repeats dropped, each window written once when the watermark passes its end and its state freed."""
    with rocksdb_state(readings.sparkSession):
        once = drop_repeats(readings, keys, late=late)
        g = once.groupBy(F.window("observed_at", f"{minutes} minutes"), *keys).agg(F.avg("speed").alias("speed"), F.count("*").alias("readings"))
        return land_batches(g.select(F.col("window.start").alias("bucket"), *keys, "speed", "readings"), path, checkpoint)
