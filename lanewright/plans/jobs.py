"""Whole jobs: chains of the operators, one function each. Paths are given by the caller; nothing is collected but control rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.functions.values import half_even
from lanewright.operators import demand, digests, network, quality, routes, spatial, store, tolls, traveltime, trips
from lanewright.scratch import leaves_no_scratch, materialise
from lanewright.sources import selection

# Largest share of suspect rows that still passes, by domain, and of conflicting duplicate keys.
SUSPECT_LIMITS = {"trips": 0.15, "readings": 0.20, "network": 0.05, "mapping": 0.10}
CONFLICT_LIMIT = 0.01


def gate(df: DataFrame, domain: str, metric: str = "suspect_ratio") -> DataFrame:
    """The gate record of a flagged table; raises where it blocks."""
    record = quality.gate_records(trips.suspect_ratio(df), domain, metric, "suspect_ratio", SUSPECT_LIMITS[domain])
    if record.first().decision == "block":
        raise quality.QualityError(f"{domain}: too many suspect rows")
    return record


def stop(violations: DataFrame, what: str) -> None:
    """Raise with the rules that are broken (a row each, so few)."""
    if bad := violations.collect():
        raise quality.QualityError(f"{what}: {[tuple(r) for r in bad]}")


def travel_time(spark: SparkSession, raw: DataFrame, mapping: DataFrame, lengths: DataFrame, table: str, today: str) -> DataFrame:
    """Feed to served table: clean, fan out, drop slow, weight, convert, check, merge, publish. Returns the snapshot rows.

    A reading whose time can't be read belongs to no slot and is left out.
    """
    return travel_times(spark, [raw], mapping, lengths, table, today)


@leaves_no_scratch
def travel_times(spark: SparkSession, feeds: list[DataFrame], mapping: DataFrame, lengths: DataFrame, table: str, today: str, once: bool = False) -> DataFrame:
    """``travel_time`` of feeds one after the other; how segments are dealt is planned once. ``once`` as in ``link_plan``.

    The table is published with a segment's slots as lists; ``store.current`` reads it by rows. Before a version is written, those
    before the current one are removed.
    """
    plan = traveltime.link_plan(mapping, lengths, once)
    for raw in feeds:
        _travel_time(spark, raw, plan, table, today)
    return traveltime.snapshot_rows(store.current(spark, table))


@leaves_no_scratch
def _travel_time(spark: SparkSession, raw: DataFrame, plan: DataFrame, table: str, today: str) -> None:
    timed = traveltime.clean_readings(raw).filter("observed_at IS NOT NULL")
    slots = materialise(traveltime.fanned_values(traveltime.drop_slow(timed), plan), "slots")  # checked, then merged
    if not slots.filter("bad > 0").isEmpty():
        raise quality.QualityError("travel times must be positive")
    state, lists = traveltime.stored_lists(spark, table)
    if state is not None:
        store.drop_old(spark, table, 1)
    merged, lists = traveltime.merge_lists(slots, state, lists, today, dict(timed.dtypes)["observed_at"])
    store.publish(merged, table, cube=lists)


@leaves_no_scratch
def intake_readings(spark: SparkSession, source: DataFrame, network_df: DataFrame, required: list[str], marker: str, out: str, now: str) -> bool:
    """New feed rows with gaps filled; a missing column or too many suspect rows leave the marker where it was."""
    if absent := quality.absent_columns(source, required):
        raise quality.QualityError(f"columns absent: {absent}")
    typed = source.withColumn("_at", F.try_to_timestamp("data_as_of"))

    def sink(new: DataFrame, number: int) -> None:
        flagged = new.drop("_at").withColumn(trips.SUSPECT, traveltime.reading_suspect(F.lit(now).cast("timestamp")))
        gate(flagged, "readings")
        readings = new.select(F.col("link_id").alias("segment_id"), F.col("speed").try_cast("double").alias("speed"), F.col("_at").alias("observed_at"))
        store.write_batch(traveltime.fill_buckets(readings.filter("observed_at IS NOT NULL"), network_df), out, number)

    return selection.take_new(spark, typed, "_at", marker, sink)


def intake_trips(frames: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Each kind standardised and written if its columns are there and its suspect share passes; one bad input stops no other."""
    routed = {}
    for kind, df in frames.items():
        if quality.absent_columns(df, list(trips.LAYOUTS[kind])):
            routed[kind] = "excluded: columns absent"
            continue
        flagged = trips.standardise(df, kind)
        if flagged.agg(F.coalesce(F.avg(F.col(trips.SUSPECT).cast("double")), F.lit(0.0))).first()[0] > SUSPECT_LIMITS["trips"]:
            routed[kind] = "excluded: suspect rows"
            continue
        store.overwrite(flagged, f"{out}/{kind}")
        routed[kind] = "passed"
    return routed


def daily_cube(spark: SparkSession, silver: DataFrame, month: str, zones: DataFrame, stage: str, live: str) -> None:
    """A month's grid staged, checked and moved into the live partitions."""
    store.write_partitions(demand.daily_grid(demand.valid_pickups(silver, month=month), zones), stage)
    staged = spark.read.option("basePath", stage).parquet(stage)
    stop(demand.cube_violations(staged, month, zones), month)
    store.write_partitions(staged, live, dynamic=True)
    store.remove(spark, stage)


def monthly_cubes(spark: SparkSession, manifest: DataFrame, kinds: DataFrame, silver: DataFrame, zones: DataFrame, stage: str, live: str, done: DataFrame | None = None) -> list[str]:
    """The cube of each month whose inputs of all kinds are there and that isn't done yet; the other months wait. What was built.

    ``manifest`` and ``kinds`` as in ``selection.complete_months``, ``done`` (month). Each month is staged in a folder of its own.
    """
    ready = selection.complete_months(manifest, kinds).filter("ready").select("month")
    months = [r.month for r in (ready if done is None else selection.not_done(ready, done, "month")).orderBy("month").collect()]  # a row a month
    for month in months:
        daily_cube(spark, silver, month, zones, f"{stage}/{month}", live)
    return months


def _rolling_plan(daily: DataFrame, mapping: DataFrame, weeks: int) -> tuple[dict, DataFrame]:
    """What a rolling publication rests on, as control values, and the rows of its window."""
    w = demand.latest_dates(daily, 7 * weeks).first()
    plan = {"window_end": str(w.window_end), "mapping_hash": digests.version_of(mapping, ["segment_id"], ["segment_id", "zone_id"])}
    return plan, daily.filter(F.col("date").between(F.lit(w.window_start), F.lit(w.window_end)))


@leaves_no_scratch
def rolling_publish(spark: SparkSession, live: str, mapping: DataFrame, weeks: int, table: str, state: str, export: str | None = None) -> bool:
    """Weekday means expanded, published and exported if the window or the mapping changed; the state row is written last.

    The published table has each segment's week as a list; ``store.current`` reads it by rows (segment_id, type, dow, time, value).

    An empty mapping is refused before anything is made. The window's rows and the mapping are copied first and the plan is made
    again from the copies: what agrees with the plan and what is published are the same rows, whatever lands meanwhile. A run that
    fails on the way has no state row and is repeated whole.
    """
    if mapping.isEmpty():
        raise quality.QualityError("the mapping is empty")
    # a mapping may be one small file: its digests are made side by side all the same
    mapping = mapping.select("segment_id", "zone_id").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "segment_id")
    plan, window = _rolling_plan(spark.read.option("basePath", live).parquet(live), mapping, weeks)
    if not store.publish_needed(store.read_state(spark, state), **plan):
        return False
    window, mapping = materialise(window, "window"), materialise(mapping, "mapping")
    store.same_plan(plan, _rolling_plan(window, mapping, weeks)[0])
    rolled = materialise(demand.weekday_means(window, weeks), "weekday-means")  # checked, expanded and exported
    if not demand.sample_gate(rolled, weeks).first().ok or not demand.bad_means(rolled).isEmpty():
        raise quality.QualityError("weekday means are incomplete")
    values = store.replacement(demand.week_lists(rolled, mapping))
    store.publish(values, table, lambda written: stop(demand.week_violations(written, mapping), "segment values"), cube=demand.WEEK)
    if export is not None:
        store.export_json(demand.demand_snapshot(rolled), export)
    store.write_state(spark, state, status="published", **plan)
    return True


def length_table(spark: SparkSession, network_df: DataFrame, table: str) -> DataFrame:
    """Lengths with their GLOBAL row merged in, segments that are gone removed; returns the removal report."""
    new = network.lengths_with_global(network.positive_lengths(network_df))
    old = store.current(spark, table)
    merged = new if old is None else store.upsert(old, new, ["segment_id"])
    report = store.stale_report(merged, new, "segment_id")
    store.publish(store.keep_valid(merged, new, "segment_id"), table)
    return report


def network_dimension(spark: SparkSession, raw: DataFrame, table: str, rows: tuple[int, int]) -> DataFrame:
    """Cleaned, one row per segment, flagged; published if duplicates agree and few rows are suspect."""
    clean = network.clean_network(raw)
    rest = [c for c in clean.columns if c != "segment_id"]
    if quality.duplicate_profile(clean, ["segment_id"], rest).first().conflict_ratio > CONFLICT_LIMIT:
        raise quality.QualityError("duplicate segments disagree")
    flagged = network.flag_network(network.first_of(clean, ["segment_id"], rest))
    limit = SUSPECT_LIMITS["network"]
    store.publish(flagged, table, lambda written: stop(network.network_violations(written, rows, limit), "network"))
    return store.current(spark, table)


@leaves_no_scratch
def zone_mapping(spark: SparkSession, segments: DataFrame, zones: DataFrame, table: str, state: str, cell: float, polygons: tuple[int, int] = (1, 10_000)) -> DataFrame:
    """Segments mapped to zones, checked, published; the version marker is written only then."""
    stop(spatial.zone_violations(zones, polygons), "zones")
    if not quality.duplicate_keys(segments, "segment_id").isEmpty() or not segments.filter("geometry IS NULL").isEmpty():
        raise quality.QualityError("segments repeat or lack a geometry")
    mapping = spatial.flag_mapping(spatial.segments_to_zones(segments, zones, cell))
    limit = SUSPECT_LIMITS["mapping"]
    store.publish(mapping, table, lambda written: stop(spatial.mapping_violations(written, segments, demand.ZONES, limit), "mapping"))
    mapping = store.current(spark, table)
    store.write_state(spark, state, version=digests.version_of(mapping, ["segment_id"], ["segment_id", "zone_id"]))
    return mapping


@leaves_no_scratch
def toll_table(spark: SparkSession, segments: DataFrame, fence: DataFrame, facilities: DataFrame, rates: DataFrame, flat_rate: float, table: str) -> DataFrame:
    members = spatial.segments_in_fence(segments.select("segment_id", geo.wkt_points(F.col("geometry")).alias("points")), fence)
    matches = tolls.match_facilities(segments.select("segment_id", "street_name"), facilities)
    stop(tolls.mapping_violations(matches, ["segment_id", "facility_key"], facilities), "facilities")
    stop(tolls.mapping_violations(members, ["segment_id"]), "fence")
    store.publish(store.replacement(tolls.toll_values(matches, rates, members, flat_rate)), table)
    return store.current(spark, table)


def backfill(spark: SparkSession, network_df: DataFrame, table: str) -> DataFrame:
    """Free-flow rows for slots that have none."""
    live = store.current(spark, table)
    store.publish(store.insert_absent(live, traveltime.backfill_slots(network_df, live), traveltime.READING_KEYS), table)
    return store.current(spark, table)


def network_profile(raw: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(duplicates, suspect ratio, distributions) of a raw network, to set limits by."""
    clean = network.clean_network(raw)
    rest = [c for c in clean.columns if c != "segment_id"]
    one = network.flag_network(network.first_of(clean, ["segment_id"], rest))
    return quality.duplicate_profile(clean, ["segment_id"], rest), trips.suspect_ratio(one), quality.distribution(one, columns)


def posted_speeds(raw: DataFrame) -> DataFrame:
    """One reference speed per segment."""
    clean = network.clean_network(raw)
    return traveltime.reference_speeds(network.first_of(clean.select("segment_id", "speed_limit"), ["segment_id"], ["speed_limit"]))


def score_routes(routes_df: DataFrame, slots: DataFrame, lengths: DataFrame, values: DataFrame | None, mapping: DataFrame, zone_values: DataFrame, toll_df: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(route_id, segments, type, date, time) requests to (scores, tier summary); malformed ones still get their defaults."""
    ok = routes.valid_request(F.col("segments"), F.col("type"), F.col("date"), F.col("time"))
    rows = routes_df.withColumn("type", F.when(ok, F.col("type"))).select("route_id", "type", "date", "time", F.posexplode("segments").alias("pos", "segment_id"))
    scored = routes.score(rows.withColumn("pos", F.col("pos").cast("long")), slots, lengths, values, mapping, zone_values, toll_df, as_of)
    return scored, routes.tier_summary(scored, routes.TIERS)


def route_values(spark: SparkSession, *request_and_tables) -> tuple[DataFrame, DataFrame]:
    """As ``score_routes``, with the values alone: (a list per route, whole numbers for types 1 and 2; tier summary).

    The scores are written once: the lists and the summary are made of the same rows.
    """
    scored = materialise(score_routes(*request_and_tables)[0], "scores")
    return routes.value_lists(scored), routes.tier_summary(scored, routes.TIERS)
