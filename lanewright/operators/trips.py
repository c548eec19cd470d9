"""Trip tables of several layouts brought to one schema, with doubtful rows flagged and kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewright.functions.values import flag

SUSPECT = "is_suspect"
TRIP_SCHEMA = T.StructType([
    T.StructField("pickup_datetime", T.TimestampType()),
    T.StructField("dropoff_datetime", T.TimestampType()),
    T.StructField("pickup_location_id", T.IntegerType()),
    T.StructField("dropoff_location_id", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
])
_PLACES = {"PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id"}
_RIDE = {"passenger_count": "passenger_count", "trip_distance": "trip_distance"}
#: Source column -> common column, by layout.
LAYOUTS = {
    "yellow": {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", **_PLACES, **_RIDE},
    "green": {"lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime", **_PLACES, **_RIDE},
    "fhv": {"pickup_datetime": "pickup_datetime", "dropOff_datetime": "dropoff_datetime", "PUlocationID": "pickup_location_id", "DOlocationID": "dropoff_location_id"},
    "fhvhv": {"pickup_datetime": "pickup_datetime", "dropoff_datetime": "dropoff_datetime", **_PLACES, "trip_miles": "trip_distance"},
}
ZONE_RANGE = (1, 265)


def rename_layout(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    if absent := [c for c in layout if c not in df.columns]:
        raise ValueError(f"columns absent: {absent}")
    return df.select([F.col(c).alias(layout.get(c, c)) for c in df.columns])


def fit_schema(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """Exactly the schema's columns: absent ones as typed nulls, others cast, unfit values null."""
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def trip_suspect(has: set[str], zones: tuple[int, int] = ZONE_RANGE) -> Column:
    """Null times or places, places out of range, negative optional values where the layout has them."""
    out = [F.col(c).isNull() for c in ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")]
    out += [~F.col(c).between(*zones) for c in ("pickup_location_id", "dropoff_location_id")]
    out += [F.col(c) < 0 for c in ("passenger_count", "trip_distance") if c in has]
    return flag(reduce(lambda a, b: a | b, out))


def standardise(df: DataFrame, kind: str, layouts: dict = LAYOUTS) -> DataFrame:
    if kind not in layouts:
        raise ValueError(f"unknown layout: {kind}")
    return fit_schema(rename_layout(df, layouts[kind])).withColumn(SUSPECT, trip_suspect(set(layouts[kind].values())))


def standardise_all(frames: dict[str, DataFrame], layouts: dict = LAYOUTS) -> DataFrame:
    """One table from a frame per layout."""
    return reduce(DataFrame.unionByName, [standardise(df, kind, layouts) for kind, df in frames.items()])


def null_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: column_name, total_count, null_count, null_percent; one pass."""
    counts = df.agg(F.count("*").alias("total_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot("total_count", columns, "column_name", "null_count")
    return long.select("column_name", "total_count", "null_count", F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("total_count")), F.lit(0.0)).alias("null_percent"))


def suspect_ratio(df: DataFrame, *by: str) -> DataFrame:
    if SUSPECT not in df.columns:
        raise KeyError(f"{SUSPECT} is absent: flag the rows first")
    return df.groupBy(*by).agg(F.coalesce(F.avg(F.col(SUSPECT).cast("double")), F.lit(0.0)).alias("suspect_ratio"))
