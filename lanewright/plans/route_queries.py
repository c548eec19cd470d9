"""Registered queries of route scoring while the tables are down and exported snapshots answer, and of bulk scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.operators import routes, traveltime
from lanewright.plans import catalog as cat
from lanewright.plans import inputs as inp
from lanewright.plans.catalog import query
from lanewright.scratch import materialise

STATE_SQL = f"WITH RECURSIVE {cat.READINGS}, {cat.STATE}, {cat.REQUESTS}, {cat.TIME_SQL}"


@query(f"{STATE_SQL.replace(chr(39) + 'rds' + chr(39), chr(39) + 's3_snapshot' + chr(39))} SELECT * FROM timed")
def route_time_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Type 1 from the exported map of slots: a fresh value, else the average, else the constant."""
    snap = materialise(traveltime.snapshot_rows(inp.slot_state(spark, d)), "slot-snapshot")
    slots = snap.select("segment_id", F.explode("slots").alias("time", "v")).select("segment_id", "time", "v.*")
    return routes.with_provenance(routes.score_time(inp.route_requests(spark, d, 1), slots, "2024-01-15", storage="s3_snapshot"), 1)


@query(f"""WITH {cat.ROLLED}, {cat.MAPPING}, {cat.REQUESTS}, {cat.SLOT_VALUES} SELECT route_id, pos, segment_id, round(coalesce(z, 0), 6) AS value, CASE WHEN z IS NOT NULL THEN 's3_snapshot' ELSE 'code' END AS storage_source,
 CASE WHEN z IS NOT NULL THEN 'modeled_aggregate' ELSE 'static_default' END AS value_basis, CASE WHEN z IS NOT NULL THEN 'snapshot' ELSE 'hardcoded' END AS source FROM requests LEFT JOIN zoned USING (segment_id)""")
def route_slot_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Type 3 from the zones' values alone."""
    _, m, rolled = cat._demand_tables(spark, d)
    return routes.with_provenance(routes.score_demand(inp.route_requests(spark, d, 3), None, m, rolled), 3).withColumn("value", F.round("value", 6))


@query(f"""WITH {cat.NETWORK}, {cat.TOLLS}, {cat.REQUESTS} SELECT route_id, pos, segment_id, round(coalesce(value, 0), 6) AS value, CASE WHEN value IS NULL THEN 'code' ELSE 's3_snapshot' END AS storage_source,
 CASE WHEN value IS NULL THEN 'static_default' ELSE 'segment_value' END AS value_basis, CASE WHEN value IS NULL THEN 'hardcoded' ELSE 'snapshot' END AS source FROM requests LEFT JOIN tolls USING (segment_id)""")
def route_toll_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Type 4 from the exported tolls: absence can't be told from a missing export, so it is a constant."""
    tolls = materialise(cat._tolls(spark, d), "toll-snapshot")
    return routes.with_provenance(routes.score_toll(inp.route_requests(spark, d, 4), tolls, storage="s3_snapshot"), 4).withColumn("value", F.round("value", 6))


@query(f"""WITH RECURSIVE {cat.READINGS}, {cat.STATE}, {cat.NETWORK}, {cat.TOLLS}, {cat.LENGTHS}, {cat.REQUESTS}, {cat.TIME_SQL}
 SELECT route_id, 1 AS type, string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS whole, count(*) AS legs FROM timed GROUP BY ALL
 UNION ALL SELECT route_id, 2, string_agg(CAST(CAST(coalesce(value, v) AS BIGINT) AS VARCHAR), ',' ORDER BY pos), count(*) FROM requests LEFT JOIN lengths USING (segment_id) CROSS JOIN g GROUP BY ALL
 UNION ALL SELECT route_id, 4, NULL, count(*) FROM requests GROUP BY ALL""")
def route_value_lists(spark: SparkSession, d: str) -> DataFrame:
    """Values alone: whole numbers of types 1 and 2, doubles of type 4."""
    parts = [
        routes.score_time(inp.route_requests(spark, d, 1), inp.slot_state(spark, d), "2024-01-15").withColumn("type", F.lit(1)),
        routes.score_static(inp.route_requests(spark, d, 2), cat._lengths(spark, d)).withColumn("type", F.lit(2)),
        routes.score_toll(inp.route_requests(spark, d, 4), cat._tolls(spark, d)).withColumn("type", F.lit(4)),
    ]
    lists = routes.value_lists(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    legs = F.when(F.col("whole_values").isNull(), F.size("values")).otherwise(F.size("whole_values"))
    return lists.select("route_id", "type", F.array_join("whole_values", ",").alias("whole"), legs.cast("long").alias("legs"))
