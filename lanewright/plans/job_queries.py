"""Registered queries that run whole jobs over the derived tables: what a reader finds in the job's table afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.operators import demand, digests, store, tolls, traveltime
from lanewright.operators.quality import QualityError
from lanewright.plans import catalog as cat
from lanewright.plans import inputs as inp
from lanewright.plans import jobs
from lanewright.plans.catalog import query, r6, slot_sql
from lanewright.scratch import materialise, scratch_path

# speeds


@query(f"""WITH {cat.RAW}, {cat.NETWORK}, link AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS link_id, CAST(l_partkey AS VARCHAR) AS segment_id FROM lineitem),
 r AS (SELECT link.segment_id, TRY_CAST(speed AS DOUBLE) AS speed, TRY_CAST(data_as_of AS TIMESTAMP) AS observed_at, data_as_of >= '2024-01-16' AS late FROM raw JOIN link USING (link_id) WHERE link_points IS NOT NULL),
 s AS (SELECT *, {slot_sql('observed_at')} AS time FROM r WHERE speed >= 1 AND observed_at IS NOT NULL), w AS (SELECT *, row_number() OVER (PARTITION BY late, segment_id, time ORDER BY observed_at, speed) AS w FROM s),
 g AS (SELECT late, segment_id, time, sum(speed * w) / sum(w) AS mean, max(observed_at) AS seen FROM w GROUP BY ALL), m AS (SELECT late, segment_id, time, round_even(length_ft / 5280 / mean * 3600, 0) AS value, seen FROM g JOIN network USING (segment_id))
 SELECT segment_id, time, coalesce(b.value, a.value) AS value, coalesce(b.seen, a.seen) AS last_sample_at, CASE WHEN a.value IS NULL THEN b.value WHEN b.value IS NULL THEN a.value ELSE round_even(a.value + (b.value - a.value) / 2, 0) END AS avg,
 CASE WHEN a.value IS NULL OR b.value IS NULL THEN 1 ELSE 2 END AS count FROM (SELECT * FROM m WHERE NOT late) a FULL JOIN (SELECT * FROM m WHERE late) b USING (segment_id, time)""")
def job_travel_time(spark: SparkSession, d: str) -> DataFrame:
    """Two feeds into one table, the later one twice: the second time all its samples are replays."""
    raw, links, lengths = materialise(inp.raw_feed(spark, d), "feed"), inp.link_rows(spark, d), inp.network(spark, d)
    table, late = scratch_path(spark, "job-travel-time"), F.col("data_as_of") >= "2024-01-16"
    jobs.travel_times(spark, [raw.filter(~late), raw.filter(late), raw.filter(late)], links, lengths, table, "2024-02-01", once=True)
    return store.current(spark, table).select("segment_id", "time", "value", "last_sample_at", "avg", "count")


LOOKS = ["2024-01-10", "2024-01-20", "2024-02-10"]


@query(f"""WITH {cat.RAW}, {cat.NETWORK}, t AS (SELECT link_id AS segment_id, TRY_CAST(speed AS DOUBLE) AS speed, TRY_CAST(data_as_of AS TIMESTAMP) AS seen FROM raw),
 k AS (SELECT *, CASE WHEN seen < TIMESTAMP '{LOOKS[0]}' THEN 0 WHEN seen < TIMESTAMP '{LOOKS[1]}' THEN 1 ELSE 2 END AS batch FROM t WHERE seen > (SELECT max(seen) - INTERVAL 6 HOUR FROM t WHERE seen < TIMESTAMP '{LOOKS[0]}')),
 b AS (SELECT batch, time_bucket(INTERVAL 30 MINUTE, seen) AS bucket, segment_id FROM k), every AS (SELECT segment_id, CASE WHEN speed_limit > 0 THEN speed_limit ELSE 25 END AS ref, batch, bucket FROM network, (SELECT DISTINCT batch, bucket FROM b)),
 made AS (SELECT batch, segment_id, greatest(1.0, ref * (0.3 + CAST('0x' || substr(md5(segment_id || '|' || strftime(bucket, '%Y-%m-%d %H:%M:%S')), 1, 5) AS BIGINT) / 1048576.0)) AS speed FROM every WHERE (bucket, segment_id) NOT IN (SELECT (bucket, segment_id) FROM b))
 SELECT batch, segment_id, false AS synthetic, count(*) AS readings, round(sum(speed), 4) AS speeds FROM k GROUP BY ALL UNION ALL SELECT batch, segment_id, true, count(*), round(sum(speed), 4) FROM made GROUP BY ALL""")
def job_reading_intake(spark: SparkSession, d: str) -> DataFrame:
    """Three looks at a growing feed. Each is tried first with a feed of bad speeds, which is refused and leaves the marker."""
    feed, net = materialise(inp.raw_feed(spark, d), "feed"), inp.network(spark, d)
    out, marker = scratch_path(spark, "job-readings"), scratch_path(spark, "job-readings-marker")
    columns = ["link_id", "speed", "link_points", "data_as_of"]
    for end in LOOKS:
        now = feed.filter(F.col("data_as_of") < end)
        try:
            jobs.intake_readings(spark, now.withColumn("speed", F.lit("bad")), net, columns, marker, out, "2024-02-10")
        except QualityError:
            jobs.intake_readings(spark, now, net, columns, marker, out, "2024-02-10")
        else:
            raise AssertionError("a feed of bad speeds was taken")
    return store.batches(spark, out).groupBy("batch", "segment_id", "synthetic").agg(F.count("*").alias("readings"), F.round(F.sum("speed"), 4).alias("speeds"))


# trips and demand


@query(f"""WITH {cat.STANDARD}, s AS (SELECT kind, avg(CAST(is_suspect AS INT)) AS r FROM flagged GROUP BY ALL)
 SELECT kind, 'passed' AS route, is_suspect, count(*) AS rows, count(passenger_count) AS passengers FROM flagged WHERE kind IN (SELECT kind FROM s WHERE r <= 0.15) GROUP BY ALL
 UNION ALL SELECT kind, 'excluded: suspect rows', NULL, 0, 0 FROM s WHERE r > 0.15 UNION ALL SELECT 'green', 'excluded: columns absent', NULL, 0, 0""")
def job_trip_intake(spark: SparkSession, d: str) -> DataFrame:
    """Trips of four kinds, one without most columns: what was written of each, or why nothing was."""
    out = scratch_path(spark, "job-trips")
    routed = jobs.intake_trips({**inp.trip_frames(spark, d), "green": inp.trips(spark, d)}, out)
    excluded = spark.createDataFrame([(k, r) for k, r in routed.items() if r != "passed"], "kind string, route string")
    found = excluded.withColumns({"is_suspect": F.lit(None).cast("boolean"), "rows": F.lit(0).cast("long"), "passengers": F.lit(0).cast("long")})
    for kind in (k for k, r in routed.items() if r == "passed"):
        rows = spark.read.parquet(f"{out}/{kind}").groupBy(F.lit(kind).alias("kind"), F.lit("passed").alias("route"), "is_suspect")
        found = found.unionByName(rows.agg(F.count("*").alias("rows"), F.count("passenger_count").alias("passengers")))
    return found


#: A month later the trips fill February and reach into March.
MOVED = cat.GRID.replace("SELECT ts AS pickup_datetime", "SELECT ts + INTERVAL 31 DAY AS pickup_datetime")


def moved_trips(spark: SparkSession, d: str) -> DataFrame:
    return inp.trips(spark, d).withColumn("pickup_datetime", F.col("pickup_datetime") + F.expr("INTERVAL 31 DAYS"))


@query(f"WITH {MOVED} SELECT zone_id, type, date, time, value FROM daily WHERE date < DATE '2024-03-01'")
def job_daily_cubes(spark: SparkSession, d: str) -> DataFrame:
    """February has all its inputs and is built once; March lacks a kind and waits; a cube of January without its last day is refused."""
    stage, live = scratch_path(spark, "job-stage"), scratch_path(spark, "job-live")
    e = inp.table(spark, d, "events").select(F.date_format(F.col("ts") + F.expr("INTERVAL 31 DAYS"), "yyyy-MM").alias("month"), F.col("event_type").alias("kind")).distinct()
    manifest = e.withColumns({"path": F.concat_ws("/", "month", "kind"), "done": (F.col("month") == "2024-02") | (F.col("kind") != "error")})
    kinds, silver, zones = e.select("kind").distinct(), materialise(moved_trips(spark, d), "moved-trips"), inp.zones(spark)
    built = jobs.monthly_cubes(spark, manifest, kinds, silver, zones, stage, live)
    done = spark.createDataFrame([(m,) for m in built], "month string")
    if jobs.monthly_cubes(spark, manifest, kinds, silver, zones, stage, live, done):
        raise AssertionError("a month was built twice")
    try:
        jobs.daily_cube(spark, inp.trips(spark, d), "2024-01", zones, f"{stage}/short", live)
    except QualityError:
        return spark.read.option("basePath", live).parquet(live).select("zone_id", "type", "date", "time", "value")
    raise AssertionError("a month without one of its days was published")


CHANGED = "mapping AS (SELECT CAST(c_custkey AS VARCHAR) AS segment_id, CASE WHEN c_custkey % 500 = 8 THEN 1 ELSE c_nationkey + 1 END AS zone_id FROM customer)"


@query(f"""WITH {cat.ROLLED}, {CHANGED} SELECT 'segment' AS kind, segment_id || '#' || dow || '#' || time AS key, round(value, 6) AS value FROM mapping JOIN rolled USING (zone_id)
 UNION ALL SELECT 'zone', zone_id || '#' || dow || '#' || time, round(value, 6) FROM rolled UNION ALL SELECT 'runs', 'True,False,True', 2.0""")
def job_rolling_publish(spark: SparkSession, d: str) -> DataFrame:
    """Published, not published again, and published after some segments moved to another zone: the table, the export, the runs."""
    live, table, state, export = (scratch_path(spark, f"job-rolling-{x}") for x in ("live", "table", "state", "export"))
    store.write_partitions(demand.daily_grid(demand.valid_pickups(inp.trips(spark, d)), inp.zones(spark)), live)
    m = inp.mapping(spark, d)
    moved = m.withColumn("zone_id", F.when(F.col("segment_id").cast("long") % 500 == 8, 1).otherwise(F.col("zone_id")))
    runs = [jobs.rolling_publish(spark, live, x, cat.WEEKS, table, state, export) for x in (m, m, moved)]
    values = store.current(spark, table).select(F.lit("segment").alias("kind"), F.concat_ws("#", "segment_id", "dow", "time").alias("key"), r6("value"))
    exported = spark.read.schema("key string, value double").json(export).select(F.lit("zone").alias("kind"), "key", r6("value"))
    said = spark.createDataFrame([("runs", ",".join(map(str, runs)), float(sum(runs)))], "kind string, key string, value double")
    return values.unionByName(exported).unionByName(said)


# network, zones, tolls


def raw_network(spark: SparkSession, d: str) -> DataFrame:
    """Text columns; every third segment twice, every 200th a second time with another speed."""
    k = F.col("p_partkey")
    p = inp.table(spark, d, "part").select(
        F.concat(F.lit(" "), k.cast("string"), F.lit(" ")).alias("SegmentID"), F.regexp_replace("p_name", " ", "   ").alias("Street"), (F.col("p_retailprice") * F.when(k % 40 == 0, -1).otherwise(1)).cast("string").alias("SHAPE_Length"),
        F.when(k % 6 > 0, (k % 6).cast("string")).otherwise(" ").alias("LBoro"), F.when(k % 50 == 0, " ").otherwise(F.concat(F.lit("n"), k.cast("string"))).alias("NodeIDFrom"), F.lit("m").alias("NodeIDTo"),
        F.when(k % 7 == 0, " ").otherwise(F.col("p_size").cast("string")).alias("POSTED_SPEED"), k,
    )
    other = p.filter(k % 200 == 1).withColumn("POSTED_SPEED", F.lit("9"))
    return p.unionByName(p.filter(k % 3 == 0)).unionByName(other).drop("p_partkey")


RAW_NETWORK = """one AS (SELECT p_partkey AS k, nullif(upper(trim(regexp_replace(replace(p_name, ' ', '   '), '\\s+', ' ', 'g'))), '') AS street_name, p_retailprice * (CASE WHEN p_partkey % 40 = 0 THEN -1 ELSE 1 END) AS length_ft,
 CASE WHEN p_partkey % 6 > 0 THEN CAST(p_partkey % 6 AS VARCHAR) ELSE '' END AS borough_code, CASE WHEN p_partkey % 7 > 0 THEN CAST(p_size AS INT) END AS speed_limit FROM part),
 twice AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE k % 3 = 0 UNION ALL SELECT * REPLACE (9 AS speed_limit) FROM one WHERE k % 200 = 1),
 dim AS (SELECT CAST(k AS VARCHAR) AS segment_id, any_value(street_name) AS street_name, any_value(length_ft) AS length_ft, any_value(borough_code) AS borough_code, min(speed_limit) AS speed_limit, k % 40 = 0 AND any_value(length_ft) < 0 OR k % 50 = 0 AS is_suspect FROM twice GROUP BY k)"""


@query(f"WITH {RAW_NETWORK} SELECT segment_id, street_name, round(length_ft, 6) AS length_ft, borough_code, speed_limit, is_suspect FROM dim")
def job_network_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Published; then a network with a speed of 99 everywhere is refused, and one of too few rows."""
    raw, table = materialise(raw_network(spark, d), "raw-network"), scratch_path(spark, "job-network")
    jobs.network_dimension(spark, raw, table, (1, 10**12))
    for bad, rows in ((raw.withColumn("POSTED_SPEED", F.lit("99")), (1, 10**12)), (raw, (10**12, 10**13))):
        try:
            jobs.network_dimension(spark, bad, table, rows)
        except QualityError:
            continue
        raise AssertionError("a bad network was published")
    return store.current(spark, table).select("segment_id", "street_name", r6("length_ft"), "borough_code", "speed_limit", "is_suspect")


@query(f"""WITH {RAW_NETWORK}, n AS (SELECT k, count(*) AS n, count(DISTINCT speed_limit) + max(CAST(speed_limit IS NULL AS INT)) AS v FROM twice GROUP BY k)
 SELECT 'duplicates' AS part, '' AS column_name, u.metric, u.value FROM (SELECT CAST(sum(n) AS DOUBLE) AS a, CAST(count(*) AS DOUBLE) AS b, CAST(count(*) FILTER (n > 1) AS DOUBLE) AS c, CAST(count(*) FILTER (n > 1 AND v = 1) AS DOUBLE) AS e, CAST(count(*) FILTER (v > 1) AS DOUBLE) AS f, round(avg(CAST(v > 1 AS INT)), 6) AS g FROM n) x,
 LATERAL (VALUES ('total_rows', a), ('unique_keys', b), ('duplicate_keys', c), ('exact_duplicate_keys', e), ('conflicting_keys', f), ('conflict_ratio', g)) u(metric, value)
 UNION ALL SELECT 'suspects', '', 'suspect_ratio', round(avg(CAST(is_suspect AS INT)), 6) FROM dim
 """ + "".join(f" UNION ALL SELECT 'distribution', '{c}', u.metric, u.value FROM (SELECT CAST(count({c}) AS DOUBLE) AS a, CAST(min({c}) AS DOUBLE) AS b, quantile_cont({c}, 0.5) AS p, quantile_cont({c}, 0.95) AS q, quantile_cont({c}, 0.99) AS r, CAST(max({c}) AS DOUBLE) AS z FROM dim) x, LATERAL (VALUES ('n', a), ('min', round(b, 6)), ('p50', round(p, 6)), ('p95', round(q, 6)), ('p99', round(r, 6)), ('max', round(z, 6))) u(metric, value)" for c in ("length_ft", "speed_limit")))
def job_network_profile(spark: SparkSession, d: str) -> DataFrame:
    """The three reports as rows (part, column_name, metric, value)."""
    raw = materialise(raw_network(spark, d), "raw-network")
    duplicates, suspects, spread = jobs.network_profile(raw, ["length_ft", "speed_limit"])

    def rows(part: str, report: DataFrame) -> DataFrame:
        keyed = report if "column_name" in report.columns else report.withColumn("column_name", F.lit(""))
        metrics = [c for c in keyed.columns if c != "column_name"]
        long = keyed.select("column_name", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in metrics]).unpivot("column_name", metrics, "metric", "value")
        return long.select(F.lit(part).alias("part"), "column_name", "metric", "value")

    return rows("duplicates", duplicates).unionByName(rows("suspects", suspects)).unionByName(rows("distribution", spread))


MIDDLE = [(1, -200.0, -200.0), (2, -200.0, 0.0), (3, 0.0, -200.0), (4, 0.0, 0.0)]
MIDDLE_SQL = "z(zone_id, x0, y0) AS (VALUES " + ", ".join(map(str, MIDDLE)) + ")"


def middle_zones(spark: SparkSession, shown: int = 4) -> DataFrame:
    rows = [(z, f"B{z}", f"POLYGON (({x} {y}, {x + 200} {y}, {x + 200} {y + 200}, {x} {y + 200}, {x} {y}))") for z, x, y in MIDDLE[:shown]]
    return spark.createDataFrame(rows, "zone_id int, borough string, wkt string").select("zone_id", "borough", geo.wkt_parts(F.col("wkt")).alias("parts"))


def wkt_segments(spark: SparkSession, d: str) -> DataFrame:
    p = inp.plane_points(spark, d)
    return p.select(F.col("segment_id").cast("string").alias("segment_id"), F.format_string("LINESTRING (%s %s, %s %s)", *[F.col(f"v{k}").cast("string") for k in (1, 2, 3, 4)]).alias("geometry"))


MIDPOINTS = f"""{cat.PLANE}, {MIDDLE_SQL}, m AS (SELECT CAST(segment_id AS VARCHAR) AS segment_id, (v1 + v3) / 2 AS x, (v2 + v4) / 2 AS y FROM p),
 d AS (SELECT segment_id, zone_id, sqrt(pow(greatest(x0 - x, 0, x - x0 - 200), 2) + pow(greatest(y0 - y, 0, y - y0 - 200), 2)) AS dist FROM m, z),
 placed AS (SELECT segment_id, CAST(arg_min(zone_id, (dist, zone_id)) AS INT) AS zone_id, min(dist) AS dist FROM d GROUP BY segment_id)"""


@query(f"WITH {MIDPOINTS} SELECT segment_id, zone_id, 'B' || zone_id AS borough, CASE WHEN dist = 0 THEN 'contains' ELSE 'nearest' END AS mapping_method, round(dist, 6) AS distance_ft, dist > 0 AS is_suspect, true AS recorded FROM placed")
def job_zone_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Mapped and recorded; then a mapping by one zone alone is refused (most segments lie outside it), and the record stays."""
    segments, table, state = wkt_segments(spark, d), scratch_path(spark, "job-mapping"), scratch_path(spark, "job-mapping-state")
    jobs.zone_mapping(spark, segments, middle_zones(spark), table, state, cell=50.0)
    try:
        jobs.zone_mapping(spark, segments, middle_zones(spark, 1), table, state, cell=50.0)
    except QualityError:
        found = store.current(spark, table)
        recorded = store.read_state(spark, state)["version"] == digests.version_of(found, ["segment_id"], ["segment_id", "zone_id"])
        return found.withColumns({"distance_ft": F.round("distance_ft", 6), "recorded": F.lit(recorded)})
    raise AssertionError("a mapping of doubtful rows was published")


@query(f"WITH {cat.NETWORK}, {cat.TOLLS} SELECT segment_id, round(value, 6) AS value FROM tolls")
def job_toll_table(spark: SparkSession, d: str) -> DataFrame:
    """Segments laid out by size, those of size 5 at most inside the fence."""
    x, y = F.col("p_size") * 10, F.col("p_partkey") % 100
    lines = inp.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("segment_id"), F.upper("p_name").alias("street_name"), F.format_string("LINESTRING (%d %d, %d %d)", x, y, x + 1, y).alias("geometry"))
    fence = spark.createDataFrame([("POLYGON ((-5 -5, 55 -5, 55 105, -5 105, -5 -5))",)], "wkt string").select(geo.wkt_parts(F.col("wkt")).alias("parts"))
    out = jobs.toll_table(spark, lines, fence, tolls.facility_table(spark, cat.PATTERNS), tolls.rate_table(spark, cat.RATES), cat.FLAT, scratch_path(spark, "job-tolls"))
    return out.withColumn("value", F.round("value", 6))


# routes

_MIXED = cat.ORACLES["route_mixed"].replace("l_orderkey % 5 + 1 AS type", "CASE WHEN l_orderkey % 7 > 0 AND l_orderkey % 5 < 4 THEN l_orderkey % 5 + 1 END AS type").replace("pos, 5, segment_id", "pos, type, segment_id").replace("WHERE type = 5", "WHERE type IS NULL")


@query(f"""SELECT route_id, type, CASE WHEN type <= 2 THEN string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY pos) END AS whole, CASE WHEN type IS NULL OR type > 2 THEN round(sum(value), 6) END AS total,
 count(*) AS legs, count(*) FILTER (source = 'hardcoded') AS hardcoded FROM ({_MIXED}) GROUP BY route_id, type""")
def job_route_values(spark: SparkSession, d: str) -> DataFrame:
    """Requests as arrays, of all types and an unknown one; every seventh has a date that is none. These two are of no type and get the default."""
    r = inp.route_requests(spark, d)
    r = r.groupBy("route_id").agg(F.array_sort(F.collect_list(F.struct("pos", "segment_id"))).alias("legs"))
    r = r.select("route_id", F.col("legs.segment_id").alias("segments"), (F.col("route_id") % 5 + 1).cast("int").alias("type"), F.when(F.col("route_id") % 7 == 0, "2024-13-01").otherwise("2024-01-15").alias("date"), F.lit("08:00").alias("time"))
    values, m, rolled = cat._demand_tables(spark, d)
    lists, tiers = jobs.route_values(spark, r, inp.slot_state(spark, d), cat._lengths(spark, d), values, m, rolled, cat._tolls(spark, d), "2024-01-15")
    total = F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6)
    out = lists.select("route_id", "type", F.array_join("whole_values", ",").alias("whole"), total.alias("total"))
    return out.join(tiers.select("route_id", F.col("total").alias("legs"), "hardcoded"), "route_id")


# what jobs keep between runs


@query("SELECT CAST(p_partkey AS VARCHAR) AS segment_id, CASE WHEN p_size <= 40 THEN CAST(p_size AS DOUBLE) ELSE 25.0 END AS reference_speed FROM part")
def reference_cache(spark: SparkSession, d: str) -> DataFrame:
    """Reference speeds built once; a second caller reads them and builds nothing."""
    path = scratch_path(spark, "reference")

    def never() -> DataFrame:
        raise AssertionError("a table that was there was built again")

    store.cached_table(spark, path, lambda: traveltime.reference_speeds(inp.network(spark, d)).select("segment_id", "reference_speed"))
    return store.cached_table(spark, path, never)


@query("""WITH w AS (SELECT max(o_orderdate)::DATE AS newest, count(*) AS n FROM orders), m AS (SELECT count(*) AS n FROM customer), k AS (SELECT count(*) AS n FROM customer WHERE c_custkey % 3 > 0)
 SELECT s.step, CAST(CASE WHEN s.step = 3 THEN newest - 1 ELSE newest END AS VARCHAR) AS window_end, CAST(CASE WHEN s.step IN (4, 5, 6) THEN k.n ELSE m.n END AS VARCHAR) AS rows, s.needed, s.agrees FROM w, m, k,
 (VALUES (0, true, false), (1, false, true), (2, false, true), (3, true, false), (4, true, false), (5, false, true), (6, true, false)) s(step, needed, agrees)""")
def publish_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Whether to publish, and whether the record agrees with the plan: before any record, after it, again, for an earlier window,
    for fewer rows, after that was recorded, and after the record's file was spoilt."""
    state = scratch_path(spark, "decisions")
    newest = inp.table(spark, d, "orders").agg(F.to_date(F.max("o_orderdate")).alias("d")).select("d", F.date_sub("d", 1).alias("e")).first()
    m = inp.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("segment_id"), F.col("c_nationkey").alias("zone_id"))
    version = lambda x: digests.version_of(x, ["segment_id"], ["segment_id", "zone_id"])
    whole = {"window_end": str(newest.d), "mapping_hash": version(m)}
    fewer = {**whole, "mapping_hash": version(m.filter("cast(segment_id AS long) % 3 > 0"))}
    rows = []
    for step, plan in enumerate([whole, whole, whole, {**whole, "window_end": str(newest.e)}, fewer, fewer, fewer]):
        if step in (1, 5):
            store.write_state(spark, state, status="published", **plan)
        if step == 6:
            spark.range(1).select(F.lit("not a table").alias("value")).coalesce(1).write.mode("overwrite").text(state)
        found = store.read_state(spark, state)
        try:
            store.same_plan(plan, found)
            agrees = True
        except QualityError:
            agrees = False
        rows.append((step, plan["window_end"], plan["mapping_hash"].split("-")[0], store.publish_needed(found, **plan), agrees))
    return spark.createDataFrame(rows, "step int, window_end string, rows string, needed boolean, agrees boolean")


@query("SELECT p_partkey AS id, p_size AS size FROM part WHERE p_size <= 40")
def staged_publication(spark: SparkSession, d: str) -> DataFrame:
    """A version is written, checked and only then seen: the second one holds a size above 40 and never is."""
    path = scratch_path(spark, "staged")
    p = inp.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))
    check = lambda written: jobs.stop(written.filter("size > 40").agg(F.lit("size").alias("rule"), F.count("*").alias("n")).filter("n > 0"), "sizes")
    store.publish(p.filter("size <= 40"), path, check)
    try:
        store.publish(p, path, check)
    except QualityError:
        store.drop_old(spark, path)
        return store.current(spark, path)
    raise AssertionError("a version that fails its check was published")


@query(f"""WITH {cat.PLANE}, t AS (SELECT segment_id, CAST(printf('%.7f', v1) AS DOUBLE) AS x1, CAST(printf('%.7f', v2) AS DOUBLE) AS y1, CAST(printf('%.7f', v3) AS DOUBLE) AS x2, CAST(printf('%.7f', v4) AS DOUBLE) AS y2 FROM p)
 SELECT segment_id, CASE WHEN segment_id % 7 > 0 THEN 2 END AS points, CASE WHEN segment_id % 7 > 0 THEN x1 END AS x1, CASE WHEN segment_id % 7 > 0 THEN y1 END AS y1, CASE WHEN segment_id % 7 > 0 THEN x2 END AS x2, CASE WHEN segment_id % 7 > 0 THEN y2 END AS y2 FROM t""")
def link_points_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Lines as "lat,lon lat,lon" and back. Every fifth text has bad pairs between, which are skipped; every seventh has one good pair."""
    n, text = F.col("segment_id"), geo.to_link_points(F.col("points"))
    text = F.when(n % 7 == 0, F.concat(F.split_part(text, F.lit(" "), F.lit(1)), F.lit(" 40.7"))).when(n % 5 == 0, F.regexp_replace(text, " ", " 40.7,x  ,-73 ")).otherwise(text)
    p = inp.plane_lines(spark, d).select("segment_id", geo.link_points(text).alias("q"))
    at = lambda i, c: F.get("q", F.lit(i))[c]
    return p.select("segment_id", F.when(F.col("q").isNotNull(), F.size("q")).alias("points"), at(0, "x").alias("x1"), at(0, "y").alias("y1"), at(1, "x").alias("x2"), at(1, "y").alias("y2"))
