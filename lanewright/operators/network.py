"""The road-network dimension: cleaning, deterministic deduplication, length statistics, graph extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.functions.values import clean_street, flag, half_even, number
from lanewright.operators.trips import SUSPECT

GLOBAL = "GLOBAL"
#: Source column -> dimension column.
NETWORK_COLUMNS = {
    "SegmentID": "segment_id", "Street": "street_name", "SHAPE_Length": "length_ft", "LBoro": "borough_code", "NodeIDFrom": "node_from",
    "NodeIDTo": "node_to", "SHAPE": "geometry", "POSTED_SPEED": "speed_limit", "Number_Travel_Lanes": "lanes",
}
BOROUGHS = ["1", "2", "3", "4", "5", ""]
NUMBERS = {"length_ft": "double", "speed_limit": "int", "lanes": "int"}


def clean_network(raw: DataFrame, columns: dict[str, str] = NETWORK_COLUMNS) -> DataFrame:
    """Names mapped, codes trimmed, numbers coerced (blank is null), streets normalised; other columns trimmed and kept."""
    out = raw.select([F.col(c).alias(columns.get(c, c)) for c in raw.columns])
    done = {c: number(F.col(c), NUMBERS[c]) if c in NUMBERS else clean_street(F.col(c)) if c == "street_name" else F.trim(F.col(c)) for c in out.columns}
    return out.withColumns(done)


def first_of(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the first by a total order, nulls last."""
    o = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*o))).filter("_n = 1").drop("_n")


def network_suspect(columns: list[str]) -> Column:
    """Negative length or lanes, a posted speed outside 1..80, a blank node; null numbers are fine."""
    out = F.lit(False)
    for c in ("length_ft", "lanes"):
        if c in columns:
            out = out | flag(F.col(c) < 0)
    if "speed_limit" in columns:
        out = out | flag(~F.col("speed_limit").between(1, 80))
    for c in ("node_from", "node_to"):
        if c in columns:
            out = out | F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    return out


def flag_network(df: DataFrame) -> DataFrame:
    return df.withColumn(SUSPECT, network_suspect(df.columns))


def network_violations(network: DataFrame, rows: tuple[int, int], suspect_limit: float) -> DataFrame:
    """Rows (rule, n) with n > 0 for each broken rule of a flagged network: ids, boroughs (blank is one), size, share of suspects.

    An unknown (null) borough is none of the listed ones and isn't counted; suspects count only beyond the limit.
    """
    one = network.agg(
        F.count_if(F.col("segment_id").isNull()).alias("null_ids"), F.count_if(~F.col("borough_code").isin(BOROUGHS)).alias("unknown_boroughs"),
        F.count_if(F.col(SUSPECT)).alias("flagged"), F.count("*").alias("rows"),
    )
    keys = network.filter("segment_id IS NOT NULL").groupBy("segment_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated_ids"))
    off = F.greatest(F.lit(rows[0]) - F.col("rows"), F.col("rows") - F.lit(rows[1]), F.lit(0))
    all_ = one.crossJoin(keys).withColumns({"row_count_off": off, "suspects": F.when(F.col("flagged") > F.col("rows") * suspect_limit, F.col("flagged")).otherwise(0)})
    rules = ["null_ids", "repeated_ids", "unknown_boroughs", "row_count_off", "suspects"]
    return all_.select(*[F.col(r).cast("long").alias(r) for r in rules]).unpivot([], rules, "rule", "n").filter("n > 0")


def positive_lengths(network: DataFrame) -> DataFrame:
    return network.filter(F.col("length_ft") > 0).select("segment_id", "length_ft")


def lengths_with_global(lengths: DataFrame) -> DataFrame:
    """Whole lengths and a GLOBAL row with their median; an empty input gives no GLOBAL row."""
    rows = lengths.select("segment_id", half_even(F.col("length_ft")).cast("double").alias("value"))
    mid = rows.agg(F.lit(GLOBAL).alias("segment_id"), half_even(F.median("value")).cast("double").alias("value")).filter("value IS NOT NULL")
    return rows.unionByName(mid)


def road_graph(network: DataFrame, default_speed: float = 25.0) -> tuple[DataFrame, DataFrame]:
    """(nodes (node, x, y), edges (node_from, node_to, length_ft, speed, segment_id)) of segments with two points at least.

    A node that several segments give takes the point of the least segment id.
    """
    g = network.withColumn("pts", geo.wkt_points(F.col("geometry"))).filter(F.size("pts") >= 2)
    ends = g.select("segment_id", F.explode(F.array(
        F.struct(F.col("node_from").alias("node"), F.element_at("pts", 1).alias("p")), F.struct(F.col("node_to").alias("node"), F.element_at("pts", -1).alias("p"))
    )).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.min(F.struct("segment_id", "e.p")).alias("m")).select("node", "m.p.x", "m.p.y")
    edges = g.select("node_from", "node_to", "length_ft", F.coalesce(F.col("speed_limit").cast("double"), F.lit(default_speed)).alias("speed"), "segment_id")
    return nodes, edges
