"""Checks over whole tables: one aggregation per report, violations as rows rather than exceptions.

``require`` turns a report into an exception where a job must stop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.functions.values import flag
from lanewright.scratch import materialise


class QualityError(ValueError):
    """A critical check failed."""

#: Size of quantile sketches, and the rank error that goes with it.
SKETCH_SIZE, SKETCH_ERROR = 400, 0.01


def absent_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def not_null(column: str, mostly: float = 1.0) -> dict:
    return {"kind": "not_null", "column": column, "mostly": mostly}


def between(column: str, low=None, high=None, mostly: float = 1.0) -> dict:
    """Bounds are inclusive; nulls are ignored."""
    return {"kind": "between", "column": column, "low": low, "high": high, "mostly": mostly}


def row_count(low: int = 1, high: int | None = None) -> dict:
    return {"kind": "row_count", "low": low, "high": high}


def distinct_count(column: str, low: int = 0, high: int | None = None, approximate: bool = False) -> dict:
    return {"kind": "distinct_count", "column": column, "low": low, "high": high, "approximate": approximate}


def is_in(column: str, values: list, mostly: float = 1.0) -> dict:
    return {"kind": "is_in", "column": column, "values": values, "mostly": mostly}


def _bad(e: dict) -> Column:
    c = F.col(e["column"])
    if e["kind"] == "not_null":
        return c.isNull()
    if e["kind"] == "is_in":
        return ~c.isin(e["values"])
    out = F.lit(False)
    if e["low"] is not None:
        out = out | (c < F.lit(e["low"]))
    return out | (c > F.lit(e["high"])) if e["high"] is not None else out


def expectation_report(df: DataFrame, expectations: list[dict], *by: str) -> DataFrame:
    """Rows (position, kind, column_name, element_count, unexpected_count, observed, success, exception) from one pass.

    A check of a column that is absent fails with ``exception`` set; the others go on.
    """
    aggs, rows = [F.count("*").alias("n")], []
    for i, e in enumerate(expectations):
        name = e.get("column", "")
        if name and name not in df.columns:
            rows.append((i, e, None))
            continue
        if e["kind"] == "row_count":
            aggs.append(F.count("*").cast("double").alias(f"x{i}"))
        elif e["kind"] == "distinct_count":
            count = F.approx_count_distinct(name) if e["approximate"] else F.count_distinct(name)
            aggs.append(count.cast("double").alias(f"x{i}"))
        else:
            aggs.append(F.count_if(flag(_bad(e))).cast("double").alias(f"x{i}"))
            aggs.append((F.count("*") if e["kind"] == "not_null" else F.count(name)).alias(f"n{i}"))
        rows.append((i, e, f"x{i}"))
    one = df.groupBy(*by).agg(*aggs)

    def record(i: int, e: dict, x: str | None) -> Column:
        none = F.lit(None)
        head = [F.lit(i).alias("position"), F.lit(e["kind"]).alias("kind"), F.lit(e.get("column")).cast("string").alias("column_name"), F.col("n").alias("element_count")]
        if x is None:
            return F.struct(*head, none.cast("long").alias("unexpected_count"), none.cast("double").alias("observed"), F.lit(False).alias("success"), F.lit("column is absent").alias("exception"))
        v = F.col(x)
        if e["kind"] in ("row_count", "distinct_count"):
            ok = (v >= e["low"]) & (v <= e["high"] if e["high"] is not None else F.lit(True))
            unexpected, seen = none.cast("long"), v
        else:
            share = F.coalesce(F.try_divide(F.col(f"n{i}") - v, F.col(f"n{i}")), F.lit(1.0))
            ok, unexpected, seen = share >= e["mostly"], v.cast("long"), share
        return F.struct(*head, unexpected.alias("unexpected_count"), seen.cast("double").alias("observed"), ok.alias("success"), none.cast("string").alias("exception"))

    return one.select(*by, F.explode(F.array(*[record(*r) for r in rows])).alias("r")).select(*by, "r.*")


def require(report: DataFrame, success: str = "success", what: str = "check") -> None:
    """Raise with the first failures of a report (which has a row per check, so it is small)."""
    bad = report.filter(~F.col(success)).limit(10).collect()
    if bad:
        raise QualityError(f"{what} failed: {[r.asDict() for r in bad]}")


def gate_records(ratios: DataFrame, domain: str, metric: str, value: str, limit: float, *extra: str) -> DataFrame:
    """One record for each decision, passed or not: domain, metric, value (6 digits), threshold, decision."""
    return ratios.select(
        F.lit(domain).alias("domain"), F.lit(metric).alias("metric"), F.round(F.col(value), 6).alias("value"),
        F.lit(float(limit)).alias("threshold"), F.when(F.col(value) <= limit, "pass").otherwise("block").alias("decision"), *extra,
    )


def route_files(df: DataFrame, file_col: str, expectations: list[dict], suspect: Column, limit: float) -> DataFrame:
    """Per input file: failed soft checks and the suspect ratio decide nothing for other files; files above the limit are excluded."""
    df = df.withColumn("_file", F.col(file_col))
    soft = expectation_report(df, expectations, "_file").groupBy("_file").agg(F.count_if(~F.col("success")).alias("soft_failures"))
    ratio = df.groupBy("_file").agg(F.avg(flag(suspect).cast("double")).alias("suspect_ratio"))
    out = ratio.join(soft, "_file")
    return out.select(F.col("_file").alias(file_col), "soft_failures", "suspect_ratio", F.when(F.col("suspect_ratio") <= limit, "passed").otherwise("excluded").alias("route"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_profile(df: DataFrame, keys: list[str], conflict: list[str]) -> DataFrame:
    """One row: rows, keys, repeated keys, those whose rows agree, those whose rows differ, and their share of keys; null is a value."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*conflict)).alias("variants"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_keys"), F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.count_if((F.col("n") > 1) & (F.col("variants") == 1)).alias("exact_duplicate_keys"), F.count_if(F.col("variants") > 1).alias("conflicting_keys"),
        F.coalesce(F.avg((F.col("variants") > 1).cast("double")), F.lit(0.0)).alias("conflict_ratio"),
    )


def running_counts(df: DataFrame, value: str) -> tuple[DataFrame, int]:
    """Rows (value, n, before): distinct values, their rows and the rows of all smaller ones; and the number of rows.

    Values are dealt by range: counts run within a range, and only a row per range is in one place. Nulls are left out.
    """
    per = df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n")).filter("value IS NOT NULL")
    per = materialise(per.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "running-counts")
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = per.groupBy("range").agg(F.sum("n").alias("all")).select("range", F.coalesce(F.sum("all").over(whole), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    out = per.withColumn("upto", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(ranges), "range")
    return out.select("value", "n", (F.col("start") + F.col("upto")).alias("before")), per.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def distribution(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Per column: count, min, p50, p95, p99, max. Exact ones by running counts, interpolated between two neighbours."""
    shares = (0.5, 0.95, 0.99)
    if not exact:
        aggs = []
        for c in columns:
            p = F.percentile_approx(F.col(c).cast("double"), list(shares), 10_000)
            aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n"), F.min(c).cast("double").alias("min"), p.alias("p"), F.max(c).cast("double").alias("max")).alias(c))
        rows = df.agg(*aggs).select(F.explode(F.array(*columns)).alias("r"))
        return rows.select("r.column_name", "r.n", "r.min", F.col("r.p")[0].alias("p50"), F.col("r.p")[1].alias("p95"), F.col("r.p")[2].alias("p99"), "r.max")
    out = []
    for c in columns:
        per, rows = running_counts(df, c)

        def at(k: int) -> Column:
            """The value at place k of the sorted column."""
            return F.max(F.when((F.col("before") <= k) & (F.col("before") + F.col("n") > k), F.col("value"))).cast("double")

        marks = []
        for share, name in zip(shares, ("p50", "p95", "p99"), strict=True):
            place = share * max(rows - 1, 0)
            low = int(place)
            marks.append((at(low) + (at(min(low + 1, max(rows - 1, 0))) - at(low)) * (place - low)).alias(name))
        out.append(per.agg(F.lit(c).alias("column_name"), F.lit(rows).cast("long").alias("n"), F.min("value").cast("double").alias("min"), *marks, F.max("value").cast("double").alias("max")))
    return reduce(DataFrame.unionByName, out)


def profile_sketches(df: DataFrame, columns: list[str], by: list[str], k: int = SKETCH_SIZE) -> DataFrame:
    """(by, column_name, n, min, max, sketch): a quantile sketch of each column per part, to be stored beside the part.

    One pass and one shuffle for all columns: values are unpivoted and sketched before they move. Nulls and NaN are left out; a
    part without a value of a column has no row for it.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("v")
    rows = df.select(*by, values).select(*by, "v.column_name", "v.value").filter("value IS NOT NULL AND NOT isnan(value)")
    return rows.groupBy(*by, "column_name").agg(
        F.count("*").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")
    )


def merged_profile(sketches: DataFrame, by: list[str] | None = None, k: int = SKETCH_SIZE) -> DataFrame:
    """(by, column_name, n, min, p50, p95, p99, max) over the parts of each group, from their sketches alone.

    The rank of a quantile is off by ``SKETCH_ERROR`` of the rows at most, in 99 of 100 cases, however many parts are merged.
    """
    g = sketches.groupBy(*(by or []), "column_name").agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("_s")
    )
    at = lambda q: F.kll_sketch_get_quantile_double("_s", F.lit(q))
    return g.select(*(by or []), "column_name", "n", "min", at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"), "max")


def content_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    """Order-free digest of a table: row count, and the sum modulo 2**60 and xor of 60-bit row hashes."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return df.select(h.alias("h")).agg(
        F.count("*").alias("rows"), F.coalesce(F.pmod(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(1 << 60).cast("decimal(38,0)")), F.lit(0)).cast("long").alias("hash_sum"), F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")).alias("hash_xor")
    )


def offender_sample(df: DataFrame, value: str, k: int = 5) -> DataFrame:
    """The first k distinct values in order, and how many more there are; one row."""
    distinct = df.select(value).distinct()
    first = distinct.orderBy(value).limit(k).agg(F.sort_array(F.collect_list(value)).alias("sample"))
    return first.crossJoin(distinct.agg(F.greatest(F.count("*") - k, F.lit(0)).alias("more")))


def set_difference(expected: DataFrame, actual: DataFrame, *keys: str) -> DataFrame:
    """Rows of keys that are only expected ("missing") or only there ("extra")."""
    e, a = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    return e.join(a, list(keys), "left_anti").withColumn("side", F.lit("missing")).unionByName(a.join(e, list(keys), "left_anti").withColumn("side", F.lit("extra")))
