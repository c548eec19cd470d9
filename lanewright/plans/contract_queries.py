"""Registered queries of the contracts: tables spoilt so that every rule fires, each rule counted again by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.operators import demand, network, spatial
from lanewright.plans import catalog as cat
from lanewright.plans import inputs as inp
from lanewright.plans import job_queries as jq
from lanewright.plans.catalog import query
from lanewright.scratch import materialise

_SLOT_SET = "(SELECT time FROM slots)"


def _rules(found: dict[str, str], source: str) -> str:
    """Each rule's count from its own SQL, those above 0."""
    return "SELECT rule, CAST(n AS BIGINT) AS n FROM (" + " UNION ALL ".join(f"SELECT '{rule}' AS rule, ({sql}) AS n" for rule, sql in found.items()) + f") {source} WHERE n > 0"


# February by zone and slot; spoilt in a zone or a date of its own for each rule
_CUBE = f"""{jq.MOVED}, whole AS (SELECT * FROM daily WHERE date <> DATE '2024-02-10' AND zone_id <> 8),
 spoilt AS (SELECT CASE WHEN zone_id = 9 THEN 99 ELSE zone_id END AS zone_id, CASE WHEN zone_id = 4 AND time = '0030' THEN 4 ELSE type END AS type, date, CASE WHEN zone_id = 6 AND time = '0130' THEN '0015' ELSE time END AS time,
 CASE WHEN zone_id = 3 AND time = '0000' THEN NULL WHEN zone_id = 5 AND time = '0100' THEN -1.0 ELSE value END AS value FROM (SELECT * FROM whole UNION ALL SELECT * FROM whole WHERE zone_id = 7 AND time = '0200'))"""


@query(f"WITH {_CUBE} " + _rules({
    "null_values": "SELECT count(*) FROM spoilt WHERE value IS NULL",
    "wrong_type": "SELECT count(*) FROM spoilt WHERE type <> 3",
    "negative_values": "SELECT count(*) FROM spoilt WHERE value < 0",
    "unknown_slots": f"SELECT count(*) FROM spoilt WHERE time NOT IN {_SLOT_SET}",
    "outside_month": "SELECT count(*) FROM spoilt WHERE strftime(date, '%Y-%m') <> '2024-02'",
    "duplicate_keys": "SELECT count(*) FROM (SELECT 1 FROM spoilt GROUP BY zone_id, type, date, time HAVING count(*) > 1)",
    "missing_dates": "SELECT 29 - count(DISTINCT date) FROM spoilt WHERE strftime(date, '%Y-%m') = '2024-02'",
    "missing_zones": "SELECT 25 - count(DISTINCT zone_id) FROM spoilt WHERE zone_id <= 25",
    "extra_zones": "SELECT count(DISTINCT zone_id) FROM spoilt WHERE zone_id > 25",
    "row_count_off": "SELECT abs(count(*) - 25 * 48 * 29) FROM spoilt",
}, "r"))
def cube_contract(spark: SparkSession, d: str) -> DataFrame:
    """All ten rules of a month's cube."""
    zone, time = F.col("zone_id"), F.col("time")
    whole = demand.daily_grid(jq.moved_trips(spark, d), inp.zones(spark)).filter((F.col("date") != "2024-02-10") & (zone != 8))
    both = whole.unionByName(whole.filter((zone == 7) & (time == "0200")))
    spoilt = both.select(
        F.when(zone == 9, 99).otherwise(zone).alias("zone_id"), F.when((zone == 4) & (time == "0030"), 4).otherwise(F.col("type")).alias("type"), "date", F.when((zone == 6) & (time == "0130"), "0015").otherwise(time).alias("time"),
        F.when((zone == 5) & (time == "0100"), -1.0).when((zone != 3) | (time != "0000"), F.col("value")).alias("value"),
    )
    return demand.cube_violations(materialise(spoilt, "spoilt"), "2024-02", inp.zones(spark))


_SEGMENTS = f"""{cat.ROLLED}, {cat.MAPPING}, m AS (SELECT segment_id, CASE WHEN CAST(segment_id AS INT) % 20 <> 1 THEN zone_id END AS zone_id FROM mapping UNION ALL SELECT * FROM mapping WHERE CAST(segment_id AS INT) % 20 = 2),
 v AS (SELECT segment_id, type, dow, time, value, CAST(segment_id AS INT) % 20 AS k FROM mapping JOIN rolled USING (zone_id)),
 spoilt AS (SELECT segment_id, CASE WHEN k = 4 AND dow = 'MON' THEN 2 ELSE type END AS type, CASE WHEN k = 5 AND time = '0030' THEN lower(dow) ELSE dow END AS dow, CASE WHEN k = 6 AND dow = 'SUN' THEN '24' || time ELSE time END AS time,
 CASE WHEN k = 7 AND time = '0000' THEN NULL WHEN k = 8 AND time = '0000' THEN -0.5 ELSE value END AS value FROM (SELECT * FROM v WHERE k <> 9 UNION ALL SELECT * FROM v WHERE k = 10 AND dow = 'TUE'))"""


@query(f"WITH {_SEGMENTS} " + _rules({
    "mapping_nulls": "SELECT count(*) FROM m WHERE segment_id IS NULL OR zone_id IS NULL",
    "mapping_repeats": "SELECT count(*) - count(DISTINCT segment_id) FROM m",
    "null_values": "SELECT count(*) FROM spoilt WHERE value IS NULL",
    "wrong_type": "SELECT count(*) FROM spoilt WHERE type <> 3",
    "negative_values": "SELECT count(*) FROM spoilt WHERE value < 0",
    "unknown_weekdays": "SELECT count(*) FROM spoilt WHERE dow <> upper(dow)",
    "unknown_slots": f"SELECT count(*) FROM spoilt WHERE time NOT IN {_SLOT_SET}",
    "duplicate_keys": "SELECT count(*) FROM (SELECT 1 FROM spoilt GROUP BY segment_id, type, dow, time HAVING count(*) > 1)",
    "uncovered_segments": "SELECT count(DISTINCT segment_id) - (SELECT count(DISTINCT segment_id) FROM spoilt) FROM m",
    "row_count_off": "SELECT abs((SELECT count(*) FROM spoilt) - 336 * count(DISTINCT segment_id)) FROM m",
}, "r"))
def segment_contract(spark: SparkSession, d: str) -> DataFrame:
    """All ten rules of segment values and their mapping."""
    m, k = inp.mapping(spark, d), F.col("segment_id").cast("int") % 20
    rolled = demand.weekday_means(demand.daily_grid(inp.trips(spark, d), inp.zones(spark)), cat.WEEKS)
    v = demand.expand_to_segments(rolled, m).withColumn("k", k)
    # some rows twice, in the pass that makes them
    v = v.filter("k <> 9").withColumn("again", F.explode(F.expr("sequence(1, IF(k = 10 AND dow = 'TUE', 2, 1))"))).drop("again")
    spoilt = v.withColumns({
        "type": F.when(F.expr("k = 4 AND dow = 'MON'"), 2).otherwise(F.col("type")), "dow": F.when(F.expr("k = 5 AND time = '0030'"), F.lower("dow")).otherwise(F.col("dow")),
        "time": F.when(F.expr("k = 6 AND dow = 'SUN'"), F.concat(F.lit("24"), F.col("time"))).otherwise(F.col("time")),
        "value": F.when(F.expr("k = 8 AND time = '0000'"), -0.5).when(F.expr("NOT (k = 7 AND time = '0000')"), F.col("value")),
    }).drop("k")
    mapped = m.withColumn("zone_id", F.when(k != 1, F.col("zone_id"))).unionByName(m.filter(k == 2))
    return demand.segment_violations(spoilt, mapped)


_NETWORK = f"""{jq.RAW_NETWORK}, s AS (SELECT CASE WHEN CAST(segment_id AS INT) % 30 <> 1 THEN segment_id END AS segment_id, CASE WHEN CAST(segment_id AS INT) % 30 = 2 THEN 'B7' WHEN CAST(segment_id AS INT) % 30 <> 3 THEN borough_code END AS borough_code,
 is_suspect OR CAST(segment_id AS INT) % 30 = 4 AS is_suspect FROM (SELECT * FROM dim UNION ALL SELECT * FROM dim WHERE CAST(segment_id AS INT) % 30 = 5))"""


@query(f"WITH {_NETWORK} " + _rules({
    "null_ids": "SELECT count(*) FROM s WHERE segment_id IS NULL",
    "repeated_ids": "SELECT count(*) FROM (SELECT 1 FROM s WHERE segment_id IS NOT NULL GROUP BY segment_id HAVING count(*) > 1)",
    "unknown_boroughs": "SELECT count(*) FROM s WHERE borough_code = 'B7'",
    "row_count_off": "SELECT count(*) - 100 FROM s",
    "suspects": "SELECT CASE WHEN avg(CAST(is_suspect AS INT)) > 0.05 THEN count(*) FILTER (is_suspect) END FROM s",
}, "r"))
def network_contract(spark: SparkSession, d: str) -> DataFrame:
    """All five rules of the network dimension, which may have 100 rows here; a null borough is none."""
    clean, k = network.clean_network(jq.raw_network(spark, d)), F.col("segment_id").cast("int") % 30
    dim = network.flag_network(network.first_of(clean, ["segment_id"], [c for c in clean.columns if c != "segment_id"]))
    both = materialise(dim.unionByName(dim.filter(k == 5)).withColumn("k", k), "network")
    spoilt = both.withColumns({
        "segment_id": F.when(F.col("k") != 1, F.col("segment_id")), "borough_code": F.when(F.col("k") == 2, "B7").when(F.col("k") != 3, F.col("borough_code")), "is_suspect": F.col("is_suspect") | (F.col("k") == 4),
    })
    return network.network_violations(spoilt, (1, 100), 0.05)


_MAPPED = f"""{jq.MIDPOINTS}, b AS (SELECT *, CAST(segment_id AS INT) % 30 AS k FROM placed), t AS (SELECT CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN 'x' || segment_id ELSE segment_id END AS segment_id, CASE WHEN k = 3 THEN NULL WHEN k = 4 THEN 264 ELSE zone_id END AS zone_id,
 CASE WHEN k = 5 THEN 'guess' WHEN k = 6 THEN NULL WHEN dist = 0 THEN 'contains' ELSE 'nearest' END AS mapping_method, dist > 0 OR k > 20 AS is_suspect FROM (SELECT * FROM b WHERE k <> 7 UNION ALL SELECT * FROM b WHERE k = 8))"""


@query(f"WITH {_MAPPED} " + _rules({
    "null_segments": "SELECT count(*) FROM t WHERE segment_id IS NULL",
    "repeated_segments": "SELECT count(*) FROM (SELECT 1 FROM t WHERE segment_id IS NOT NULL GROUP BY segment_id HAVING count(*) > 1)",
    "missing_segments": "SELECT count(*) FROM m WHERE segment_id NOT IN (SELECT segment_id FROM t WHERE segment_id IS NOT NULL)",
    "extra_segments": "SELECT count(DISTINCT segment_id) FROM t WHERE segment_id NOT IN (SELECT segment_id FROM m)",
    "null_zones": "SELECT count(*) FROM t WHERE zone_id IS NULL",
    "zones_out_of_range": "SELECT count(*) FROM t WHERE zone_id NOT BETWEEN 1 AND 263",
    "unknown_methods": "SELECT count(*) FROM t WHERE coalesce(mapping_method, '') NOT IN ('contains', 'nearest')",
    "suspects": "SELECT CASE WHEN avg(CAST(is_suspect AS INT)) > 0.1 THEN count(*) FILTER (is_suspect) END FROM t",
}, "r"))
def mapping_contract(spark: SparkSession, d: str) -> DataFrame:
    """All eight rules of the mapping of segments to zones."""
    segments = jq.wkt_segments(spark, d)
    m = spatial.flag_mapping(spatial.segments_to_zones(segments, jq.middle_zones(spark), 50.0))
    m = materialise(m.withColumn("k", F.col("segment_id").cast("int") % 30), "mapping")
    k, both = F.col("k"), m.filter("k <> 7").unionByName(m.filter("k = 8"))
    spoilt = both.withColumns({
        "segment_id": F.when(k == 2, F.concat(F.lit("x"), F.col("segment_id"))).when(k != 1, F.col("segment_id")), "zone_id": F.when(k == 4, 264).when(k != 3, F.col("zone_id")),
        "mapping_method": F.when(k == 5, "guess").when(k != 6, F.col("mapping_method")), "is_suspect": F.col("is_suspect") | (k > 20),
    })
    return spatial.mapping_violations(spoilt, segments, demand.ZONES, 0.1)


@query("SELECT rule, n FROM (SELECT 'null_ids' AS rule, count(*) FILTER (n_nationkey % 5 = 0) AS n FROM nation UNION ALL SELECT 'without_border', count(*) FILTER (n_nationkey % 5 = 1) FROM nation UNION ALL SELECT 'open_rings', count(*) FILTER (n_nationkey % 5 = 2) FROM nation UNION ALL SELECT 'count_off', count(*) - 20 FROM nation) WHERE n > 0")
def zone_contract(spark: SparkSession, d: str) -> DataFrame:
    """Nations as squares: some without an id, some empty, some with a ring that doesn't close, and five too many."""
    k = F.col("n_nationkey")
    corner = lambda i: F.concat_ws(" ", (k + (1 if i in (1, 2) else 0)).cast("string"), F.lit("1" if i in (2, 3) else "0"))
    ring = F.concat_ws(", ", *[corner(i) for i in range(4)], F.when(k % 5 == 2, F.lit("7 7")).otherwise(corner(0)))
    wkt = F.when(k % 5 == 1, "POLYGON EMPTY").otherwise(F.concat(F.lit("POLYGON (("), ring, F.lit("))")))
    zones = inp.table(spark, d, "nation").select(F.when(k % 5 > 0, k.cast("int")).alias("zone_id"), geo.wkt_parts(wkt).alias("parts"))
    return spatial.zone_violations(zones, (1, 20))


@query(f"WITH {jq.MIDPOINTS} SELECT is_suspect, mapping_method, count(*) AS segments, round(max(distance_ft), 6) AS farthest FROM (SELECT dist > 0 AS is_suspect, CASE WHEN dist > 0 THEN 'nearest' ELSE 'contains' END AS mapping_method, dist AS distance_ft FROM placed) GROUP BY ALL")
def mapping_trust(spark: SparkSession, d: str) -> DataFrame:
    """Segments by how they were mapped, with the flag of low trust."""
    m = spatial.flag_mapping(spatial.segments_to_zones(jq.wkt_segments(spark, d), jq.middle_zones(spark), 50.0))
    return m.groupBy("is_suspect", "mapping_method").agg(F.count("*").alias("segments"), F.round(F.max("distance_ft"), 6).alias("farthest"))
