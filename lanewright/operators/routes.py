"""Route scoring in bulk: each position of a route gets a value, and says where it came from.

Requests are rows (route_id, pos, segment_id, type, date, time). Whatever is missing or malformed falls back by steps to a
constant, so every request row has a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions import timeslot as ts
from lanewright.functions.values import half_even, label_of
from lanewright.operators.network import GLOBAL
from lanewright.scratch import join_checked, materialise

#: What is served when nothing is known, by type.
DEFAULT_SECONDS, DEFAULT_LENGTH, DEFAULT_DEMAND, DEFAULT_TOLL = 45.0, 300.0, 0.0, 0.0
MOST_SEGMENTS = 500
#: Packed segments, of 200 bytes each, that are sent to every task at most.
PACKED_ROWS = 100_000
#: The older one-word name of (type, storage:basis); everything else is "hardcoded".
LEGACY = {
    1: {"rds:observed": "fresh", "memory_cache:observed": "fresh", "s3_snapshot:observed": "fresh", "rds:historical_average": "avg", "memory_cache:historical_average": "avg", "s3_snapshot:historical_average": "avg"},
    2: {"rds:segment_value": "rds", "rds:global_default": "global", "s3_snapshot:segment_value": "snapshot", "s3_snapshot:global_default": "hardcoded"},
    3: {"rds:modeled_aggregate": "rds", "s3_snapshot:modeled_aggregate": "snapshot"},
    4: {"rds:segment_value": "rds", "rds:implicit_zero": "rds", "s3_snapshot:segment_value": "snapshot"},
}
STATIC = "code:static_default"
#: Sources of values, best first.
TIERS = ["fresh", "avg", "rds", "global", "snapshot", "hardcoded"]


def valid_request(segments: Column, kind: Column, date: Column, time: Column) -> Column:
    ok = F.size(segments).between(1, MOST_SEGMENTS) & kind.isin(1, 2, 3, 4) & date.rlike(r"^\d{4}-\d{2}-\d{2}$") & time.rlike(r"^([01]\d|2[0-3]):[0-5]\d$")
    return F.coalesce(ok & date.try_cast("date").isNotNull(), F.lit(False))


def legacy_source(kind: int, token: Column) -> Column:
    return label_of(token, LEGACY[kind], "hardcoded")


def with_provenance(scored: DataFrame, kind: int) -> DataFrame:
    """The token "storage:basis" as two columns, and the older word."""
    return scored.withColumns({
        "storage_source": F.split_part("token", F.lit(":"), F.lit(1)), "value_basis": F.split_part("token", F.lit(":"), F.lit(2)),
        "source": legacy_source(kind, F.col("token")),
    }).drop("token")


def score_static(requests: DataFrame, lengths: DataFrame, storage: str = "rds") -> DataFrame:
    """Type 2: the segment's value, else the GLOBAL row, else the constant."""
    own = lengths.filter(F.col("segment_id") != GLOBAL).select("segment_id", F.col("value").alias("own"))
    default = lengths.filter(F.col("segment_id") == GLOBAL).agg(F.max("value").alias("all"))
    j = requests.join(own, "segment_id", "left").crossJoin(F.broadcast(default))
    missing = F.lit("rds:global_default") if storage == "rds" else F.when(F.col("all").isNotNull(), f"{storage}:global_default").otherwise(STATIC)
    return j.select("route_id", "pos", "segment_id", half_even(F.coalesce("own", "all", F.lit(DEFAULT_LENGTH))).alias("value"), F.when(F.col("own").isNotNull(), f"{storage}:segment_value").otherwise(missing).alias("token"))


def score_demand(requests: DataFrame, values: DataFrame | None, mapping: DataFrame, zone_values: DataFrame) -> DataFrame:
    """Type 3: (segment, weekday, slot), else the value of the segment's zone, else 0. ``values`` None: the table is down."""
    r = requests.withColumns({"dow": ts.weekday(F.col("date").cast("string").try_cast("date")), "slot": ts.slot_of_clock(F.col("time"))})
    if values is None:
        r = r.withColumn("own", F.lit(None).cast("double"))
    else:
        # of a table of 336 slots a segment only those weekdays and slots that are asked for, 336 at most, meet the requests
        asked = materialise(r.select("dow", "slot").distinct(), "asked-slots")
        own = values.select("segment_id", "dow", F.col("time").alias("slot"), F.col("value").alias("own")).join(F.broadcast(asked), ["dow", "slot"], "left_semi")
        r = r.join(own, ["segment_id", "dow", "slot"], "left")
    m = mapping.select(F.col("segment_id").cast("string").alias("segment_id"), "zone_id").dropDuplicates(["segment_id"])
    zv = zone_values.select("zone_id", "dow", F.col("time").alias("slot"), F.col("value").alias("zoned"))
    r = r.join(m, "segment_id", "left").join(zv, ["zone_id", "dow", "slot"], "left")
    token = F.when(F.col("own").isNotNull(), "rds:modeled_aggregate").when(F.col("zoned").isNotNull(), "s3_snapshot:modeled_aggregate").otherwise(STATIC)
    return r.select("route_id", "pos", "segment_id", F.coalesce("own", "zoned", F.lit(DEFAULT_DEMAND)).alias("value"), token.alias("token"))


def score_toll(requests: DataFrame, tolls: DataFrame, storage: str = "rds") -> DataFrame:
    """Type 4: most segments have no toll, so absence is a value of 0."""
    j = requests.join(tolls.select("segment_id", F.col("value").alias("own")), "segment_id", "left")
    missing = "rds:implicit_zero" if storage == "rds" else STATIC
    return j.select("route_id", "pos", "segment_id", F.coalesce("own", F.lit(DEFAULT_TOLL)).alias("value"), F.when(F.col("own").isNotNull(), f"{storage}:segment_value").otherwise(F.lit(missing)).alias("token"))


def packed_slots(slots: DataFrame, as_of: str) -> DataFrame:
    """(segment_id, slots): a segment's 48 half hours as one array of ints, twice the seconds and one more if they are fresh.

    A value sampled on ``as_of`` counts, else the slot's average; -1 where there is neither. Seconds are whole and below 2**30.
    """
    fresh = F.col("value").isNotNull() & ts.is_fresh(F.col("last_sample_at"), F.lit(as_of).cast("date"))
    v = half_even(F.when(fresh, F.col("value")).otherwise(F.col("avg"))).cast("long")
    k = F.array_position(F.array(*[F.lit(t) for t in ts.SLOTS]), F.col("time"))
    s = slots.select("segment_id", k.cast("int").alias("k"), (v * 2 + fresh.cast("int")).cast("int").alias("e")).filter("e IS NOT NULL AND k > 0")
    known = F.map_from_entries(F.collect_list(F.struct("k", "e")))
    g = s.groupBy("segment_id").agg(known.alias("m"))
    return g.select("segment_id", F.transform(F.sequence(F.lit(1), F.lit(len(ts.SLOTS))), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(-1))).alias("slots"))


def score_time(requests: DataFrame, slots: DataFrame, as_of: str, storage: str = "rds") -> DataFrame:
    """Type 1: positions in order; each is looked up at the start plus the seconds of those before it, wrapping at midnight.

    A value sampled on ``as_of`` counts, else the slot's average, else the constant. A segment that comes again is looked up
    again. Slots are packed, 200 bytes a segment, and meet the positions without a shuffle of these while they are few enough
    to be sent; a route is one fold along its positions.
    """
    packed = materialise(packed_slots(slots, as_of), "packed-slots")
    j = join_checked(requests.select("route_id", "pos", "segment_id", "time"), packed, "segment_id", "left", rows=PACKED_ROWS)
    legs = F.array_sort(F.collect_list(F.struct("pos", "segment_id", "slots")))
    routes = j.groupBy("route_id").agg(legs.alias("legs"), F.min_by("time", "pos").alias("start"))
    begin = F.coalesce(ts.clock_seconds(F.col("start")), F.lit(0)).cast("long")

    def step(a: Column, leg: Column) -> Column:
        at = F.floor(F.pmod(a["t"], F.lit(ts.DAY_SECONDS)) / (60 * ts.SLOT_MINUTES)).cast("int")
        return geo_bound(F.coalesce(F.get(leg["slots"], at), F.lit(-1)), lambda e: F.struct(
            (a["t"] + F.when(e < 0, F.lit(int(DEFAULT_SECONDS))).otherwise(F.shiftright(e, 1))).cast("long").alias("t"), F.array_append(a["out"], e).alias("out"),
        ))

    first = F.struct(begin.alias("t"), F.array().cast("array<int>").alias("out"))
    folded = routes.select("route_id", F.transform("legs", lambda x: F.struct(x["pos"].cast("long").alias("pos"), x["segment_id"].alias("segment_id"))).alias("legs"), F.aggregate("legs", first, step)["out"].alias("out"))
    o = folded.select("route_id", F.explode(F.arrays_zip("legs", "out")).alias("o")).select("route_id", "o.legs.pos", "o.legs.segment_id", F.col("o.out").alias("e"))
    value = F.when(F.col("e") < 0, F.lit(DEFAULT_SECONDS)).otherwise(F.shiftright("e", 1).cast("double"))
    token = F.when(F.col("e") < 0, STATIC).when(F.col("e") % 2 == 1, f"{storage}:observed").otherwise(f"{storage}:historical_average")
    return o.select("route_id", "pos", "segment_id", value.alias("value"), token.alias("token"))


def geo_bound(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def score(requests: DataFrame, slots: DataFrame, lengths: DataFrame, values: DataFrame | None, mapping: DataFrame, zone_values: DataFrame, tolls: DataFrame, as_of: str) -> DataFrame:
    """Requests of mixed types; unknown types get the time constant. (route_id, pos, type, segment_id, value, storage_source, value_basis, source)"""
    requests = materialise(requests, "requests")  # read once for each type
    by = {k: requests.filter(F.col("type") == k) for k in (1, 2, 3, 4)}
    parts = [
        with_provenance(score_time(by[1], slots, as_of), 1).withColumn("type", F.lit(1)), with_provenance(score_static(by[2], lengths), 2).withColumn("type", F.lit(2)),
        with_provenance(score_demand(by[3], values, mapping, zone_values), 3).withColumn("type", F.lit(3)), with_provenance(score_toll(by[4], tolls), 4).withColumn("type", F.lit(4)),
    ]
    odd = requests.filter(~F.coalesce(F.col("type").isin(1, 2, 3, 4), F.lit(False)))
    parts.append(odd.select("route_id", "pos", "segment_id", F.lit(DEFAULT_SECONDS).alias("value"), F.lit("code").alias("storage_source"), F.lit("static_default").alias("value_basis"), F.lit("hardcoded").alias("source"), "type"))
    cols = ["route_id", "pos", "type", "segment_id", "value", "storage_source", "value_basis", "source"]
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out


def tier_summary(scored: DataFrame, tiers: list[str], terminal: str = "hardcoded", by: str = "route_id", least: int = 20, share: float = 0.10) -> DataFrame:
    """Per request: a count per tier, the total, the share of the last tier, and whether it spikes."""
    g = scored.groupBy(by).agg(*[F.count_if(F.col("source") == t).alias(t) for t in tiers], F.count("*").alias("total"))
    ratio = F.col(terminal) / F.col("total")
    return g.withColumns({"terminal_ratio": ratio, "spike": (F.col("total") >= least) & (ratio > share)})


def route_totals(scored: DataFrame) -> DataFrame:
    """Per route: seconds, length, toll as sums and demand as mean."""
    of = lambda k: F.when(F.col("type") == k, F.col("value"))
    return scored.groupBy("route_id").agg(F.sum(of(1)).alias("seconds"), F.sum(of(2)).alias("length"), F.avg(of(3)).alias("demand"), F.sum(of(4)).alias("toll"))


def fastest(totals: DataFrame, *by: str) -> DataFrame:
    return totals.groupBy(*by).agg(F.min(F.struct("seconds", "route_id")).alias("m")).select(*by, "m.route_id", "m.seconds")


def value_lists(scored: DataFrame) -> DataFrame:
    """(route_id, type, values): the values alone, in order; whole numbers for types 1 and 2, which are served as such."""
    v = F.when(F.col("type").isin(1, 2), half_even(F.col("value"))).otherwise(F.col("value"))
    legs = scored.groupBy("route_id", "type").agg(F.array_sort(F.collect_list(F.struct("pos", v.alias("value")))).alias("legs"))
    whole = F.transform("legs.value", lambda x: x.cast("long"))
    return legs.select("route_id", "type", F.when(F.col("type").isin(1, 2), whole).alias("whole_values"), F.when(~F.coalesce(F.col("type").isin(1, 2), F.lit(False)), F.col("legs.value")).alias("values"))


def distinct_in_order(requests: DataFrame) -> DataFrame:
    """Each route's segments without repeats, at the position where they first came."""
    return requests.groupBy("route_id", "segment_id").agg(F.min("pos").alias("pos"))
