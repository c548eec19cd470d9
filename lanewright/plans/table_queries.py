"""Registered queries of keyed tables (parts, buckets, digests), of profiles, areas and graphs, and of jobs that end in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.operators import buckets, digests, quality, store
from lanewright.operators import network as net
from lanewright.operators.quality import QualityError
from lanewright.plans import inputs as inp
from lanewright.plans import jobs
from lanewright.plans.catalog import LENGTHS, MAPPING, NETWORK, READINGS, query, r6, slot_sql
from lanewright.scratch import materialise, scratch_path
from lanewright.sources import readers


@query("SELECT o_orderkey AS id, o_custkey AS holder, CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS load FROM orders GROUP BY ALL")
def parts_load_and_swap(spark: SparkSession, d: str) -> DataFrame:
    """Two loads in eight parts each, and a third whose first part is lost: a reader sees the second."""
    path = scratch_path(spark, "parts")
    o = inp.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("holder")).distinct()
    for load in (F.lit("first"), F.when(F.col("id") % 2 == 0, "second").otherwise("first")):
        store.commit_parts(spark, path, store.stage_parts(o.withColumn("load", load), path, 8, ["id"]))
    version = store.stage_parts(o.withColumn("load", F.lit("third")), path, 8, ["id"])
    store.remove(spark, f"{path}/versions/{version}/part=0")
    try:
        store.commit_parts(spark, path, version)
    except QualityError:
        return store.current(spark, path).drop("part")
    raise AssertionError("a version without one of its parts was published")


@query("""WITH s AS (SELECT c_custkey AS id, round(c_acctbal, 2) AS value, c_nationkey AS nation FROM customer WHERE c_custkey % 4 <> 1),
 u AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 1.0 ELSE round(c_acctbal, 2) END AS value, c_nationkey AS nation FROM customer WHERE c_custkey % 4 <> 1 OR c_custkey % 7 = 0 OR c_custkey % 9 = 0)
 SELECT id, value, nation FROM u WHERE nation IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)""")
def bucket_merge(spark: SparkSession, d: str) -> DataFrame:
    """A bucketed table after an upsert, an insertion of absent keys and a deletion by valid nations."""
    path = scratch_path(spark, "buckets")
    c = inp.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.round("c_acctbal", 2).alias("value"), F.col("c_nationkey").alias("nation"))
    buckets.create(c.filter("id % 4 <> 1"), path, ["id"], 16)
    buckets.upsert(path, c.filter("id % 7 = 0").withColumn("value", F.lit(1.0)), ["id"], 16)
    buckets.insert_absent(path, c.filter("id % 9 = 0"), ["id"], 16)
    valid = inp.table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("nation"))
    buckets.delete_stale(spark, path, valid, "nation", ["id"], 16)
    return buckets.read(spark, path).drop(buckets.BUCKET)


ROW = "sha256(concat_ws('|', coalesce(length(CAST(segment_id AS VARCHAR)) || ':' || segment_id, '-'), coalesce(length(CAST(zone_id AS VARCHAR)) || ':' || zone_id, '-')))"


@query(f"WITH {MAPPING} SELECT 0 AS range, count(*) AS rows, sha256(string_agg({ROW}, '' ORDER BY {ROW})) AS digest FROM mapping HAVING count(*) > 0")
def content_digest(spark: SparkSession, d: str) -> DataFrame:
    return digests.range_digests(inp.mapping(spark, d), ["segment_id"], ["segment_id", "zone_id"], ranges=1)


KEY_RANGE = "CAST((CAST('0x' || substr(sha256(length(segment_id) || ':' || segment_id), 1, 7) AS BIGINT) * 64) >> 28 AS INT)"


@query(f"WITH {MAPPING}, changed AS (SELECT {KEY_RANGE} AS range, count(*) AS n FROM mapping GROUP BY 1) SELECT range, n AS rows_a, n - (SELECT count(*) FROM mapping WHERE {KEY_RANGE} = range AND CAST(segment_id AS BIGINT) % 500 = 7) AS rows_b FROM changed WHERE range IN (SELECT {KEY_RANGE} FROM mapping WHERE CAST(segment_id AS BIGINT) % 500 IN (7, 8))")
def changed_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Which of 64 key ranges changed after some rows went and some moved to another zone."""
    m = inp.mapping(spark, d)
    n = F.col("segment_id").cast("long") % 500
    now = m.filter(n != 7).withColumn("zone_id", F.when(n == 8, F.col("zone_id") + 1).otherwise(F.col("zone_id")))
    keys = ["segment_id"], ["segment_id", "zone_id"], 64
    return digests.differing_ranges(digests.range_digests(m, *keys), digests.range_digests(now, *keys))


PROFILED = ["l_extendedprice", "l_quantity", "l_discount"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, CAST(min({c}) AS DOUBLE) + 0.0 AS min, CAST(max({c}) AS DOUBLE) AS max, true AS p50_ok, true AS p95_ok, true AS p99_ok FROM lineitem" for c in PROFILED))
def merged_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantile sketches by month of shipping, stored, and merged without reading the rows again; each quantile's true rank is checked."""
    li = inp.table(spark, d, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    stored = materialise(quality.profile_sketches(li, PROFILED, ["month"]), "sketches")
    found = quality.merged_profile(stored)
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in PROFILED])).alias("v")
    j = li.select(values).select("v.*").join(F.broadcast(found), "column_name")  # one row a column

    def ok(name: str, share: float):
        low, upto = F.count_if(F.col("value") < F.col(name)) / F.count("*"), F.count_if(F.col("value") <= F.col(name)) / F.count("*")
        return ((low - quality.SKETCH_ERROR <= share) & (upto + quality.SKETCH_ERROR >= share)).alias(f"{name}_ok")

    return j.groupBy("column_name", "n", (F.col("min") + 0.0).alias("min"), "max").agg(ok("p50", 0.5), ok("p95", 0.95), ok("p99", 0.99))


EDGES = "SELECT c_custkey % 50 AS node_from, c_nationkey AS node_to, c_acctbal AS length_ft, CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey % 40 AS DOUBLE) ELSE 25.0 END AS speed, CAST(c_custkey AS VARCHAR) AS segment_id FROM customer WHERE c_custkey % 11 > 0"


@query(EDGES)
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """Every eleventh segment has a single point and is no edge; every third has no posted speed."""
    c = inp.table(spark, d, "customer")
    line = F.when(F.col("c_custkey") % 11 > 0, F.format_string("LINESTRING (%d 0, %d 1)", "c_custkey", "c_nationkey")).otherwise("LINESTRING (1 1)")
    n = c.select(F.col("c_custkey").cast("string").alias("segment_id"), (F.col("c_custkey") % 50).alias("node_from"), F.col("c_nationkey").alias("node_to"), F.col("c_acctbal").alias("length_ft"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey") % 40).alias("speed_limit"), line.alias("geometry"))
    return net.road_graph(n)[1]


@query("SELECT n_nationkey AS nation, CAST(n_regionkey % 2 + 1 AS INT) AS rings, CAST(n_nationkey AS DOUBLE) AS x0, CAST(n_nationkey + 1 + 10 * (n_regionkey % 2) AS DOUBLE) AS x1 FROM nation")
def geojson_areas(spark: SparkSession, d: str) -> DataFrame:
    """Nations as squares, those of odd regions as two squares of one MultiPolygon, written as a FeatureCollection and read."""
    n = inp.table(spark, d, "nation")
    ring = lambda by: F.format_string("[[[%d,0],[%d,0],[%d,1],[%d,1],[%d,0]]]", *[F.col("n_nationkey") + by + k for k in (0, 1, 1, 0, 0)])
    odd = F.col("n_regionkey") % 2 == 1
    shape = F.when(odd, F.format_string('{"type":"MultiPolygon","coordinates":[%s,%s]}', ring(0), ring(10))).otherwise(F.format_string('{"type":"Polygon","coordinates":%s}', ring(0)))
    feature = F.format_string('{"type":"Feature","properties":{"nation":"%d"},"geometry":%s}', F.col("n_nationkey"), shape)
    path = scratch_path(spark, "geojson")
    # one feature collection is one document, however it is made
    n.agg(F.format_string('{"type":"FeatureCollection","features":[%s]}', F.array_join(F.collect_list(feature), ",")).alias("value")).write.text(path)
    f = readers.read_geojson(spark, path)
    box = geo.bounds(F.flatten("parts"))
    return f.select(F.col("properties")["nation"].cast("long").alias("nation"), F.size("parts").alias("rings"), box["x0"].alias("x0"), box["x1"].alias("x1"))


# jobs


@query(f"WITH {NETWORK}, {LENGTHS} SELECT segment_id, value FROM lengths UNION ALL SELECT 'GLOBAL', v FROM g")
def job_lengths(spark: SparkSession, d: str) -> DataFrame:
    """The length table built from all segments and again without every sixth: these are gone, and the median is new."""
    n, table = inp.network(spark, d), scratch_path(spark, "job-lengths")
    jobs.length_table(spark, n, table)
    jobs.length_table(spark, n.filter("try_cast(segment_id AS int) % 6 > 0"), table)
    return store.current(spark, table)


LIVE = f"live AS (SELECT segment_id, {slot_sql('observed_at')} AS time, round(min(speed), 2) AS avg FROM readings GROUP BY ALL)"


@query(f"""WITH {NETWORK}, {READINGS}, {LIVE}, slots AS (SELECT printf('%02d%02d', i // 2, (i % 2) * 30) AS time FROM range(48) t(i)) SELECT segment_id, time, avg FROM live UNION ALL
 SELECT segment_id, time, CAST(round_even(length_ft / 5280 / speed_limit * 3600, 0) AS DOUBLE) FROM network, slots WHERE length_ft > 0 AND speed_limit > 0 AND NOT EXISTS (SELECT 1 FROM live l WHERE l.segment_id = network.segment_id AND l.time = slots.time)""")
def job_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Stored slots stay; all others of segments with a posted speed get their free-flow time."""
    table = scratch_path(spark, "job-backfill")
    store.publish(inp.slot_state(spark, d).select("segment_id", "time", "avg", F.lit(1).cast("long").alias("count"), "last_sample_at"), table)
    return jobs.backfill(spark, inp.network(spark, d), table).select("segment_id", "time", r6("avg"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS segment_id, CASE WHEN p_size <= 40 AND p_size > 5 THEN CAST(p_size AS DOUBLE) ELSE 25.0 END AS reference_speed FROM part")
def job_posted_speeds(spark: SparkSession, d: str) -> DataFrame:
    """A raw network with every segment twice, once without a speed, and blank or zero speeds: one reference speed each."""
    p = inp.table(spark, d, "part")
    speed = F.when(F.col("p_size") > 40, " ").when(F.col("p_size") <= 5, "0").otherwise(F.col("p_size").cast("string"))
    raw = p.select(F.format_string(" %d ", "p_partkey").alias("SegmentID"), speed.alias("POSTED_SPEED"))
    return jobs.posted_speeds(raw.unionByName(raw.withColumn("POSTED_SPEED", F.lit("")))).select("segment_id", "reference_speed")
