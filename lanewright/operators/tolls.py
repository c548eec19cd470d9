"""Tolls: facilities matched by street pattern, zone charges, and their sum by segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.scratch import join_checked, materialise

#: Characters of a stretch by which plain patterns are filed, and what makes a pattern more than plain text.
GRAM, SIGNS = 3, r"[\\^$.|?*+(){}\[\]]"


def facility_table(spark: SparkSession, patterns: dict[str, str]) -> DataFrame:
    """(ordinal, facility_key, street_contains) in the order given."""
    return spark.createDataFrame([(i, k, p) for i, (k, p) in enumerate(patterns.items())], "ordinal int, facility_key string, street_contains string")


def rate_table(spark: SparkSession, rates: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(rates.items()), "facility_key string, passenger double")


def _folded(text: Column) -> Column:
    """ASCII letters as capitals: what a pattern without regard to case does."""
    return F.translate(text, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _grams(text: Column, n: Column) -> Column:
    """The distinct stretches of ``n`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))


def match_facilities(streets: DataFrame, facilities: DataFrame, few: int = 200) -> DataFrame:
    """(segment_id, facility_key, ordinal) where the street matches a facility's pattern in any case; a null street never does.

    Each distinct street is matched once. Patterns of plain text are found by an inverted index: a pattern is filed under the
    rarest of its stretches of ``GRAM`` characters (or under itself, if shorter), streets meet it on that stretch alone and are
    then searched. Up to ``few`` patterns, and those with regular-expression signs, which have no such stretch and are kept by
    hand, are sent to all streets.
    """
    names = materialise(streets.filter("street_name IS NOT NULL").select("street_name").distinct(), "streets")
    f = facilities.filter("street_contains IS NOT NULL").select("facility_key", "ordinal", "street_contains")
    f = materialise(f.withColumns({"plain": ~F.col("street_contains").rlike(SIGNS), "want": _folded(F.col("street_contains"))}), "patterns")
    searched = F.contains(_folded(F.col("street_name")), F.col("want"))
    if f.limit(few + 1).count() <= few:
        hit = F.when(F.col("plain"), searched).otherwise(F.expr("street_name rlike concat('(?i)', street_contains)"))
        found = names.join(F.broadcast(f), hit)
    else:
        odd = f.filter(~F.col("plain") | (F.length("want") == 0))
        if odd.limit(few + 1).count() > few:
            raise ValueError(f"more than {few} patterns with regular-expression signs")
        found = names.join(F.broadcast(odd), F.expr("street_name rlike concat('(?i)', street_contains)"))
        plain = f.filter(F.col("plain") & (F.length("want") > 0)).withColumn("size", F.least(F.length("want"), F.lit(GRAM)))
        sizes = [r[0] for r in plain.select("size").distinct().collect()]  # 1 .. GRAM
        each = names.select("street_name", F.explode(F.array(*[F.lit(k) for k in sizes])).alias("size"))
        each = each.select("street_name", F.explode(_grams(_folded(F.col("street_name")), F.col("size"))).alias("gram"))
        each = materialise(each, "street-grams")
        grams = plain.select("facility_key", "ordinal", "want", F.explode(_grams(F.col("want"), F.col("size"))).alias("gram"))
        common = each.join(grams.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
        # a pattern with a stretch that no street has can't match
        filed = grams.join(common, "gram", "left").groupBy("facility_key", "ordinal", "want").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("m"))
        filed = filed.filter("m.n > 0").select("facility_key", "ordinal", "want", "m.gram")
        found = found.select("street_name", "facility_key", "ordinal").unionByName(each.join(filed, "gram").filter(searched).select("street_name", "facility_key", "ordinal"))
    found = materialise(found.select("street_name", "facility_key", "ordinal"), "street-matches")
    return join_checked(streets.select("segment_id", "street_name"), found, "street_name").select("segment_id", "facility_key", "ordinal")


def unknown_facilities(matches: DataFrame, rates: DataFrame) -> DataFrame:
    return matches.join(rates, "facility_key", "left_anti")


def toll_values(matches: DataFrame, rates: DataFrame, zone_members: DataFrame, flat_rate: float) -> DataFrame:
    """(segment_id, value): the flat rate inside the zone plus the first matching facility's toll; facilities without a rate are skipped."""
    road = join_checked(matches, rates, "facility_key").groupBy("segment_id").agg(F.min(F.struct("ordinal", "passenger")).alias("m")).select("segment_id", F.col("m.passenger").alias("v"))
    flat = zone_members.select("segment_id").distinct().withColumn("v", F.lit(float(flat_rate)))
    return road.unionByName(flat).groupBy("segment_id").agg(F.sum("v").alias("value"))


def mapping_violations(mapping: DataFrame, keys: list[str], known: DataFrame | None = None) -> DataFrame:
    """Rows (rule, n): an empty mapping, null ids, repeated keys, facilities that are not known."""
    one = mapping.agg((F.count("*") == 0).cast("long").alias("empty"), F.count_if(F.col("segment_id").isNull()).alias("null_ids"))
    dup = mapping.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated_keys"))
    out = one.crossJoin(dup)
    rules = ["empty", "null_ids", "repeated_keys"]
    if known is not None:
        out = out.crossJoin(mapping.join(known, "facility_key", "left_anti").agg(F.count("*").alias("unknown_facilities")))
        rules.append("unknown_facilities")
    return out.unpivot([], rules, "rule", "n").filter("n > 0")
