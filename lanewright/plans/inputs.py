"""The domain tables derived from the supplied ones, in Spark; catalog.py has the same derivations as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("segment_id"), F.col("value").alias("speed"), F.col("ts").alias("observed_at"))


def network(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("segment_id"), F.upper("p_name").alias("street_name"), F.col("p_retailprice").alias("length_ft"),
        F.when(F.col("p_size") <= 40, F.col("p_size")).alias("speed_limit"), F.col("p_brand").alias("borough_code"),
    )


def trips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("ts").alias("pickup_datetime"), (F.col("user_id") % 25 + 1).cast("int").alias("pickup_location_id"))


def zones(spark: SparkSession) -> DataFrame:
    return spark.range(1, 26).select(F.col("id").cast("int").alias("zone_id"))


def mapping(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("segment_id"), (F.col("c_nationkey") + 1).alias("zone_id"))


def link_rows(spark: SparkSession, d: str) -> DataFrame:
    """As ``link_map``, a pair as often as the lines have it."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").cast("string").alias("link_id"), F.col("l_partkey").cast("string").alias("segment_id"))


def link_map(spark: SparkSession, d: str) -> DataFrame:
    return link_rows(spark, d).distinct()


def raw_feed(spark: SparkSession, d: str) -> DataFrame:
    """Every column text, some of it blank or bad."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("link_id"),
        F.when(F.col("event_id") % 50 == 0, "bad").when(F.col("event_id") % 70 == 0, F.lit(None)).otherwise(F.round("value", 2).cast("string")).alias("speed"),
        F.when(F.col("event_id") % 90 == 0, F.lit(None)).otherwise(F.concat_ws(" ", F.lit("40.75,-73.98"), F.lit("40.76,-73.97"))).alias("link_points"),
        F.when(F.col("event_id") % 110 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("data_as_of"),
    )


def trip_frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    e, o, li = (table(spark, d, t) for t in ("events", "orders", "lineitem"))
    return {
        "yellow": e.select(F.col("ts").alias("tpep_pickup_datetime"), F.col("ts").alias("tpep_dropoff_datetime"), (F.col("user_id") % 300).alias("PULocationID"), (F.col("user_id") % 7).alias("DOLocationID"), (F.col("event_id") % 6 - 1).alias("passenger_count"), F.col("value").alias("trip_distance"), F.col("event_type").alias("extra")),
        "fhv": o.select(F.col("o_orderdate").alias("pickup_datetime"), F.col("o_orderdate").alias("dropOff_datetime"), (F.col("o_custkey") % 265 + 1).alias("PUlocationID"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey") % 100 + 1).alias("DOlocationID")),
        "fhvhv": li.select(F.col("l_shipdate").alias("pickup_datetime"), F.col("l_shipdate").alias("dropoff_datetime"), F.col("l_suppkey").alias("PULocationID"), F.col("l_linenumber").alias("DOLocationID"), (F.col("l_quantity") - 2).alias("trip_miles")),
    }


def route_requests(spark: SparkSession, d: str, kind: int = 1) -> DataFrame:
    """Routes from orders, positions by line."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("route_id"), F.row_number().over(w).cast("long").alias("pos"), F.col("l_partkey").cast("string").alias("segment_id"),
        F.lit(kind).alias("type"), F.lit("2024-01-15").alias("date"), F.lit("08:00").alias("time"),
    )


def slot_state(spark: SparkSession, d: str, ids: str = "part") -> DataFrame:
    """Stored slots: by user, slot and day; ids are users, or parts with the same number."""
    r = readings(spark, d)
    from lanewright.functions import timeslot as ts

    g = r.groupBy("segment_id", ts.slot(F.col("observed_at")).alias("time"))
    return g.agg(F.round(F.max("speed"), 2).alias("value"), F.round(F.min("speed"), 2).alias("avg"), F.max("observed_at").alias("last_sample_at"))


def plane_points(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    at = lambda k: (F.element_at("embedding", k).cast("double") * 1000).alias(f"v{k}")
    return e.select(F.col("vec_id").alias("segment_id"), at(1), at(2), at(3), at(4), "label")


def plane_lines(spark: SparkSession, d: str) -> DataFrame:
    p = plane_points(spark, d)
    return p.select("segment_id", "label", F.array(geo.point(F.col("v1"), F.col("v2")), geo.point(F.col("v3"), F.col("v4"))).alias("points"))


#: Squares with gaps between them: (zone_id, x0, y0, side).
SQUARES = [(i * 5 + j + 1, -250.0 + 100 * i, -250.0 + 100 * j, 90.0) for i in range(5) for j in range(5)]


def square_zones(spark: SparkSession) -> DataFrame:
    rows = [(z, f"B{z % 5}", f"POLYGON (({x} {y}, {x + s} {y}, {x + s} {y + s}, {x} {y + s}, {x} {y}))") for z, x, y, s in SQUARES]
    return spark.createDataFrame(rows, "zone_id int, borough string, wkt string").select("zone_id", "borough", geo.wkt_parts(F.col("wkt")).alias("parts"))
