"""Readers: pruned multi-path scans, all-string feeds, CSV and GeoJSON with geometry, configuration as dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewright.functions import geometry as geo
from lanewright.operators.quality import QualityError

FEED_COLUMNS = ["id", "speed", "travel_time", "status", "data_as_of", "link_id", "link_points", "encoded_poly_line", "encoded_poly_line_lvls", "owner", "transcom_id", "borough", "link_name"]


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """Some columns of many Parquet paths; only those reach the scan's ReadSchema."""
    if not paths:
        raise ValueError("no paths")
    return spark.read.parquet(*paths).select(*columns)


def scan_partitioned(spark: SparkSession, base: str, date_col: str = "date", first: str | None = None, last: str | None = None) -> DataFrame:
    """A Hive-partitioned folder; the date bounds prune partitions."""
    df = spark.read.option("basePath", base).parquet(base)
    df = df.withColumn(date_col, F.to_date(date_col))
    if first is not None:
        df = df.filter(F.col(date_col) >= F.lit(first).cast("date"))
    return df.filter(F.col(date_col) <= F.lit(last).cast("date")) if last is not None else df


def read_feed(spark: SparkSession, path: str, columns: list[str] = FEED_COLUMNS) -> DataFrame:
    """Landed JSON pages, every field a string."""
    return spark.read.schema(strings(columns)).option("multiLine", True).json(path)


def read_string_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, every column a string, blanks kept as empty text."""
    return spark.read.schema(strings(columns)).option("header", True).option("emptyValue", "").option("nullValue", "\0").option("escape", '"').csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone polygons (zone_id, borough, parts) from a CSV of WKT, LocationID and borough."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return raw.select(F.col("LocationID").try_cast("int").alias("zone_id"), "borough", geo.wkt_parts(F.col("WKT")).alias("parts"))


_RINGS = "array<array<array<double>>>"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Areas (feature, properties, parts) of a FeatureCollection; another type or no features is an error.

    The rings of a MultiPolygon's polygons are parts of one area. A feature that is no area, or has no geometry, is an error
    too: none is left out in silence.
    """
    schema = "type string, features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    bad = raw.filter((F.coalesce("type", F.lit("")) != "FeatureCollection") | (F.coalesce(F.size("features"), F.lit(0)) < 1))
    if raw.isEmpty() or not bad.isEmpty():
        raise QualityError("not a FeatureCollection with features")
    f = raw.select(F.posexplode("features").alias("feature", "f"))
    kind = F.coalesce("f.geometry.type", F.lit("none"))
    if other := sorted(r[0] for r in f.select(kind.alias("kind")).filter(~F.col("kind").isin("Polygon", "MultiPolygon")).distinct().limit(20).collect()):
        raise QualityError(f"features that are no areas: {other}")
    text = F.col("f.geometry.coordinates")
    rings = F.when(kind == "Polygon", F.from_json(text, _RINGS)).otherwise(F.flatten(F.from_json(text, f"array<{_RINGS}>")))
    f = f.select("feature", "f.properties", rings.alias("rings"))
    parts = F.transform("rings", lambda r: F.transform(r, lambda p: geo.point(F.get(p, F.lit(0)), F.get(p, F.lit(1)))))
    return f.select("feature", "properties", parts.alias("parts"))


def read_config_map(spark: SparkSession, path: str, field: str, key: str, value: str, kind: str) -> DataFrame:
    """A JSON object under ``field`` as rows (key, value)."""
    raw = spark.read.schema(f"`{field}` map<string,{kind}>").option("multiLine", True).json(path)
    return raw.select(F.explode(field).alias(key, value))
