"""Pickup demand by zone: counts on a dense grid, weekday means over the latest weeks, expansion to segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.functions import timeslot as ts
from lanewright.functions.values import flag
from lanewright.operators.store import Cube, packed, unpacked
from lanewright.scratch import BROADCAST_ROWS, join_checked, materialise

TYPE_ID = 3
ZONES = (1, 263)
CUBE = ["zone_id", "type", "date", "time"]
#: A week of values as a list: 336 numbers.
WEEK = Cube("value", {"type": [TYPE_ID], "dow": list(ts.WEEKDAYS), "time": list(ts.SLOTS)})
#: Weeks of so many zones are broadcast (some 3 KB each).
ZONE_LISTS = 10_000


def valid_pickups(trips: DataFrame, zones: tuple[int, int] = ZONES, month: str | None = None) -> DataFrame:
    ok = trips.filter(F.col("pickup_datetime").isNotNull() & F.col("pickup_location_id").between(*zones))
    return ok.filter(ts.in_month(F.col("pickup_datetime"), month)) if month else ok


def slot_counts(trips: DataFrame) -> DataFrame:
    t = trips.select(F.col("pickup_location_id").cast("int").alias("zone_id"), F.to_date("pickup_datetime").alias("date"), ts.slot(F.col("pickup_datetime")).alias("time"))
    return t.groupBy("zone_id", "date", "time").agg(F.count("*").cast("double").alias("value"))


def daily_grid(trips: DataFrame, zone_ids: list[int] | DataFrame) -> DataFrame:
    """Zones x dates seen x slots, 0 where nobody was picked up.

    Zeros are unioned with the counts and summed: the grid is never joined, so a busy zone stays one row per slot.
    """
    spark = trips.sparkSession
    counts = slot_counts(trips)
    zones = zone_ids if isinstance(zone_ids, DataFrame) else spark.createDataFrame([(int(z),) for z in zone_ids], "zone_id int")
    dates = trips.select(F.to_date("pickup_datetime").alias("date")).distinct()
    # a stated grid: two short dimensions side by side, slots by explode
    grid = zones.select("zone_id").crossJoin(F.broadcast(dates)).withColumn("time", F.explode(F.array(*[F.lit(s) for s in ts.SLOTS])))
    zero = grid.select("zone_id", "date", "time", F.lit(0.0).alias("value"), F.lit(1).alias("g"))
    both = counts.withColumn("g", F.lit(0)).unionByName(zero).groupBy("zone_id", "date", "time").agg(F.sum("value").alias("value"), F.max("g").alias("g"))
    return both.filter("g = 1").select("zone_id", F.lit(TYPE_ID).alias("type"), "date", "time", "value")


def latest_dates(daily: DataFrame, days: int) -> DataFrame:
    """One row about the newest ``days`` dates: window_start, window_end, found, complete."""
    top = daily.select("date").distinct().orderBy(F.desc("date")).limit(days)
    w = top.agg(F.min("date").alias("window_start"), F.max("date").alias("window_end"), F.count("*").alias("found"))
    return w.withColumn("complete", flag((F.col("found") == days) & (F.datediff("window_end", "window_start") + 1 == days)))


def weekday_means(daily: DataFrame, weeks: int) -> DataFrame:
    """Mean and number of samples by zone, type, weekday and slot over the latest weeks; raises where a date is missing."""
    daily = materialise(daily, "daily")  # looked at for its dates, then averaged
    w = latest_dates(daily, 7 * weeks).first()
    if not w.complete:
        raise ValueError(f"{weeks} whole weeks are needed up to {w.window_end}; dates found: {w.found} from {w.window_start}")
    inside = daily.filter(F.col("date").between(F.lit(w.window_start), F.lit(w.window_end)))
    g = inside.withColumn("dow", ts.weekday(F.col("date"))).groupBy("zone_id", "type", "dow", "time")
    return g.agg(F.avg("value").alias("value"), F.count("*").alias("sample_count"))


def _text_ids(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.col("segment_id").cast("string").alias("segment_id"), F.col("zone_id").cast("int").alias("zone_id"))


def expand_to_segments(rolled: DataFrame, mapping: DataFrame, partitions: int | None = None) -> DataFrame:
    """Each segment gets its zone's values.

    Zones differ widely in their number of segments, so the fan-out is dealt by segment; the zone table is broadcast when it
    was counted and is small, which keeps that dealing, and otherwise packed to a row per zone before the join.
    """
    seg = _text_ids(mapping)
    rolled = materialise(rolled, "rolled")  # counted and joined: the means are computed once
    n = partitions or int(seg.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rolled.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        out = seg.repartition(n, "segment_id").join(F.broadcast(rolled), "zone_id")
    else:
        packed = rolled.groupBy("zone_id").agg(F.collect_list(F.struct("type", "dow", "time", "value")).alias("v"))
        out = seg.join(packed, "zone_id").repartition(n, "segment_id").select("segment_id", F.explode("v").alias("v")).select("segment_id", "v.*")
    return out.select("segment_id", "type", "dow", "time", "value")


def week_lists(rolled: DataFrame, mapping: DataFrame, partitions: int | None = None) -> DataFrame:
    """The same with a row per segment: (segment_id, value), the values of its zone as a list by ``WEEK``.

    Written so, a segment costs a row and a column of numbers instead of 336 rows of five columns. A zone whose slots are not all
    there once has no list (null).
    """
    lists = materialise(packed(rolled.select("zone_id", *WEEK.axes, WEEK.value), WEEK), "week-lists")
    n = partitions or int(mapping.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return join_checked(_text_ids(mapping).repartition(n, "segment_id"), lists, "zone_id", rows=ZONE_LISTS).select("segment_id", "value")


def cube_violations(daily: DataFrame, month: str, zone_ids: DataFrame) -> DataFrame:
    """Rows (rule, n) with n > 0 for each broken rule of a month's cube: values, keys, dates, zones, row count."""
    start, stop = ts.month_bounds(month)
    start, stop = F.to_date(start), F.to_date(stop)
    null = F.greatest(*[F.col(c).isNull() for c in [*CUBE, "value"]])
    one = daily.agg(
        F.count_if(null).alias("null_values"), F.count_if(F.col("type") != TYPE_ID).alias("wrong_type"), F.count_if(F.col("value") < 0).alias("negative_values"),
        F.count_if(~F.col("time").isin(list(ts.SLOTS))).alias("unknown_slots"), F.count_if((F.col("date") < start) | (F.col("date") >= stop)).alias("outside_month"), F.count("*").alias("rows"),
    )
    keys = daily.groupBy(*CUBE).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    days = daily.sparkSession.range(1).select(F.explode(F.sequence(start, F.date_sub(stop, 1))).alias("date"))
    dates = days.join(daily.select("date").distinct(), "date", "left_anti").agg(F.count("*").alias("missing_dates"))
    zones = zone_ids.select("zone_id").distinct()
    seen = daily.select("zone_id").distinct()
    gone = zones.join(seen, "zone_id", "left_anti").agg(F.count("*").alias("missing_zones"))
    extra = seen.join(zones, "zone_id", "left_anti").agg(F.count("*").alias("extra_zones"))
    want = zones.agg((F.count("*") * len(ts.SLOTS)).alias("per_day"))
    # one-row frames side by side
    all_ = one.crossJoin(keys).crossJoin(dates).crossJoin(gone).crossJoin(extra).crossJoin(want)
    all_ = all_.withColumn("row_count_off", F.abs(F.col("rows") - F.col("per_day") * F.datediff(stop, start)))
    rules = ["null_values", "wrong_type", "negative_values", "unknown_slots", "outside_month", "duplicate_keys", "missing_dates", "missing_zones", "extra_zones", "row_count_off"]
    return all_.select(*[F.col(r).cast("long").alias(r) for r in rules]).unpivot([], rules, "rule", "n").filter("n > 0")


def _repeated_keys(g: DataFrame) -> DataFrame:
    """(segment_id, type, dow, odd, repeated) of the groups of ``segment_violations`` whose bits tell how many keys repeat.

    ``once`` has the slots seen, ``odds`` those seen an odd number of times. Where the rows are as few as these allow, each slot
    of an even number came twice and each other once.
    """
    twice = F.bit_count(F.col("once").bitwiseAND(F.bitwise_not("odds")))
    plain = F.when(F.col("odd"), (F.col("rows") > 1).cast("int")).when(F.col("rows") == F.bit_count("once") + twice, twice)
    return g.withColumn("repeated", plain)


def segment_violations(values: DataFrame, mapping: DataFrame) -> DataFrame:
    """The same for segment values: mapping nulls and repeats, values, keys, coverage and row count.

    The values are grouped by segment, type and weekday, with the 48 slots of a group as bits; slots of other names are groups of
    their own. Only groups in which a slot came three times or more are counted key by key, from a second reading.
    With a column ``times`` a segment's rows stand for those of so many segments.
    """
    cols = ["segment_id", "type", "dow", "time", "value"]
    m = mapping.agg(F.count_if(F.col("segment_id").isNull() | F.col("zone_id").isNull()).alias("mapping_nulls"), (F.count("segment_id") - F.count_distinct("segment_id")).alias("mapping_repeats"), F.count_distinct("segment_id").alias("segments"))
    known = flag(F.col("time").isin(list(ts.SLOTS)))
    bit = F.expr("shiftleft(1L, CAST(substr(time, 1, 2) AS INT) * 2 + IF(substr(time, 3, 1) = '3', 1, 0))")
    by = [*cols[:3], "odd", "other"]
    marked = values.withColumns({"odd": ~known, "other": F.when(~known, F.col("time")), "bit": F.when(known, bit)})
    null = F.greatest(*[F.col(c).isNull() for c in cols])
    times = F.max("times") if "times" in values.columns else F.lit(1).cast("long")
    g = marked.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(null).alias("nulls"), F.count_if(F.col("value") < 0).alias("negative"), F.bit_or("bit").alias("once"), F.bit_xor("bit").alias("odds"), times.alias("times"))
    g = materialise(_repeated_keys(g), "segment-groups")  # a row per segment and weekday
    s = g.groupBy("segment_id").agg(
        F.sum("nulls").alias("null_values"), F.sum(F.when(F.col("type") != TYPE_ID, F.col("rows"))).alias("wrong_type"), F.sum("negative").alias("negative_values"),
        F.sum(F.when(~F.col("dow").isin(list(ts.WEEKDAYS)), F.col("rows"))).alias("unknown_weekdays"), F.sum(F.when(F.col("odd") & F.col("other").isNotNull(), F.col("rows"))).alias("unknown_slots"),
        F.sum("rows").alias("rows"), F.sum("repeated").alias("plain"), F.max("times").alias("times"),
    )
    sums = ["null_values", "wrong_type", "negative_values", "unknown_weekdays", "unknown_slots", "rows", "plain"]
    v = s.agg(*[F.sum(F.col(c) * F.col("times")).alias(c) for c in sums], F.sum(F.when(F.col("segment_id").isNotNull(), F.col("times"))).alias("seen")).na.fill(0)
    unclear = g.filter("repeated IS NULL").select(*[F.col(c).alias(f"_{c}") for c in cols[:3]])
    k = v.select(F.lit(0).cast("long").alias("n"))
    if not unclear.isEmpty():
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols[:3]]
        keyed = marked.filter("NOT odd").join(unclear, same, "left_semi").groupBy(*cols[:4]).agg(F.count("*").alias("n"), times.alias("times"))
        k = keyed.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("times"))), F.lit(0)).alias("n"))
    all_ = m.crossJoin(v).crossJoin(k)
    all_ = all_.withColumns({"duplicate_keys": F.col("plain") + F.col("n"), "uncovered_segments": F.abs(F.col("segments") - F.col("seen")), "row_count_off": F.abs(F.col("rows") - F.col("segments") * (7 * len(ts.SLOTS)))})
    rules = ["mapping_nulls", "mapping_repeats", "null_values", "wrong_type", "negative_values", "unknown_weekdays", "unknown_slots", "duplicate_keys", "uncovered_segments", "row_count_off"]
    return all_.select(*[F.col(r).cast("long").alias(r) for r in rules]).unpivot([], rules, "rule", "n").filter("n > 0")


def week_violations(weeks: DataFrame, mapping: DataFrame) -> DataFrame:
    """``segment_violations`` of the rows that are packed in (segment_id, value).

    Where each segment has one list, those with equal lists break the same rules as often, so a list is judged once, with the
    number of its segments: there are no more lists than zones. If a segment is null or has several lists, all are unpacked.
    """
    n = weeks.agg(F.count("*").alias("lists"), F.count_distinct("segment_id").alias("segments")).first()
    if n.lists != n.segments:
        return segment_violations(unpacked(weeks, WEEK), mapping)
    alike = weeks.groupBy("value").agg(F.count("*").alias("times")).withColumn("segment_id", F.monotonically_increasing_id().cast("string"))
    return segment_violations(unpacked(materialise(alike, "weeks-alike"), WEEK), mapping)


def sample_gate(rolled: DataFrame, weeks: int) -> DataFrame:
    """One row: least and most samples of a mean, and whether both are the number of weeks."""
    g = rolled.agg(F.min("sample_count").alias("least"), F.max("sample_count").alias("most"))
    return g.withColumn("ok", flag((F.col("least") == weeks) & (F.col("most") == weeks)))


def bad_means(rolled: DataFrame) -> DataFrame:
    null = F.greatest(*[F.col(c).isNull() for c in ("zone_id", "type", "dow", "time", "value")])
    return rolled.filter(null | flag(F.col("value") < 0) | flag(F.col("type") != TYPE_ID))


def demand_snapshot(rolled: DataFrame) -> DataFrame:
    """("zone#dow#time", value) rows."""
    return rolled.select(F.concat_ws("#", F.col("zone_id").cast("string"), "dow", "time").alias("key"), "value")
