import re
from datetime import date, timedelta
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewright.operators import demand, network, quality, store, tolls, trips
from lanewright.sources import readers, selection


def test_grid_is_dense(rows):
    t = rows("pickup_datetime timestamp, pickup_location_id int", (dt(2026, 7, 1, 8, 5), 1), (dt(2026, 7, 1, 8, 20), 1), (dt(2026, 7, 1, 9, 0), 2), (dt(2026, 6, 30, 8, 0), 1), (dt(2026, 7, 1, 8, 0), 264), (None, 1))
    out = demand.daily_grid(demand.valid_pickups(t, month="2026-07"), [1, 2])
    assert out.count() == 96
    assert {(r.zone_id, r.time, r.value) for r in out.filter("value > 0").collect()} == {(1, "0800", 2.0), (2, "0900", 1.0)}


def daily(rows, days, start=date(2026, 7, 6)):
    return rows("zone_id int, type int, date date, time string, value double", *[(1, 3, start + timedelta(d), "0800", float(d)) for d in days])


def test_monday_mean_of_twelve_weeks(rows):
    out = {r.dow: (r.value, r.sample_count) for r in demand.weekday_means(daily(rows, range(98)), 12).collect()}
    assert out["MON"] == (52.5, 12) and len(out) == 7


def test_a_missing_date_stops_the_mean(rows):
    with pytest.raises(ValueError, match="whole weeks"):
        demand.weekday_means(daily(rows, [d for d in range(14) if d != 9]), 2)


def test_expansion_and_its_contract(rows, spark):
    rolled = rows("zone_id int, type int, dow string, time string, value double", *[(z, 3, w, s, 1.0) for z in (1, 2) for w in demand.ts.WEEKDAYS for s in demand.ts.SLOTS])
    m = rows("segment_id string, zone_id int", ("a", 1), ("b", 1), ("c", 2))
    out = demand.expand_to_segments(rolled, m)
    assert out.count() == 3 * 7 * 48
    assert demand.segment_violations(out, m).isEmpty()
    assert {r.rule for r in demand.segment_violations(out.filter("segment_id <> 'c'"), m).collect()} == {"uncovered_segments", "row_count_off"}


def test_cube_contract(rows, spark):
    zones = rows("zone_id int", (1,))
    full = rows("zone_id int, type int, date date, time string, value double", *[(1, 3, date(2026, 2, d), s, 0.0) for d in range(1, 29) for s in demand.ts.SLOTS])
    assert demand.cube_violations(full, "2026-02", zones).isEmpty()
    bad = full.filter("date <> '2026-02-03'").withColumn("value", F.when(F.col("time") == "0000", -1.0).otherwise(F.col("value")))
    assert {r.rule: r.n for r in demand.cube_violations(bad, "2026-02", zones).collect()} == {"negative_values": 27, "missing_dates": 1, "row_count_off": 48}


def test_standardise(rows):
    y = rows("tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, DOLocationID int, passenger_count int, trip_distance double, fare_amount double", (dt(2026, 1, 1), dt(2026, 1, 1), 1, 2, 1, 2.0, 9.0), (dt(2026, 1, 1), None, 999, 2, -1, 2.0, 9.0))
    f = rows("pickup_datetime timestamp, dropOff_datetime timestamp, PUlocationID int, DOlocationID int", (dt(2026, 1, 1), dt(2026, 1, 1), 3, 4))
    out = trips.standardise_all({"yellow": y, "fhv": f})
    assert out.columns == [*trips.TRIP_SCHEMA.names, "is_suspect"]
    assert [r.is_suspect for r in out.collect()] == [False, True, False]
    assert trips.suspect_ratio(out).first()[0] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="absent"):
        trips.standardise(f, "green")
    with pytest.raises(KeyError):
        trips.suspect_ratio(y)


def test_expectations_record_everything(rows):
    d = rows("a int, b string", (1, "x"), (None, "y"), (300, "x"))
    r = quality.expectation_report(d, [quality.not_null("a"), quality.between("a", 1, 265), quality.not_null("zz"), quality.distinct_count("b", 1, 2), quality.row_count(1)]).orderBy("position").collect()
    assert [x.success for x in r] == [False, False, False, True, True]
    assert (r[0].unexpected_count, r[1].unexpected_count, r[2].exception) == (1, 1, "column is absent")
    with pytest.raises(quality.QualityError):
        quality.require(quality.expectation_report(d, [quality.not_null("a")]))


def test_duplicates_count_null_as_a_value(rows):
    d = rows("k int, v string", (1, "a"), (1, "a"), (2, None), (2, "b"), (3, "c"))
    r = quality.duplicate_profile(d, ["k"], ["v"]).first()
    assert (r.total_rows, r.unique_keys, r.duplicate_keys, r.exact_duplicate_keys, r.conflicting_keys) == (5, 3, 2, 1, 1)
    assert [tuple(x) for x in network.first_of(d, ["k"], ["v"]).orderBy("k").collect()] == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert_keeps_other_columns(rows):
    s = rows("id int, a string, b string", (1, "x", "y"), (2, "x", "y"))
    out = {r.id: (r.a, r.b, r.c) for r in store.upsert(s, rows("id int, a string, c int", (2, None, 5), (3, "n", 6)), ["id"]).collect()}
    assert out == {1: ("x", "y", None), 2: (None, "y", 5), 3: ("n", None, 6)}


def test_empty_sets_are_refused(rows):
    s = rows("id int", (1,))
    for f in (lambda: store.keep_valid(s, s.limit(0), "id"), lambda: store.replacement(s.limit(0))):
        with pytest.raises(quality.QualityError):
            f()


def test_publication_moves_only_after_the_check(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert store.current(spark, path) is None
    store.publish(rows("id int", (1,)), path)

    def refuse(_):
        raise quality.QualityError("no")

    with pytest.raises(quality.QualityError):
        store.publish(rows("id int", (2,)), path, refuse)
    assert [r.id for r in store.current(spark, path).collect()] == [1]


def test_dynamic_partitions_leave_others(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    store.write_partitions(rows("v int, date string", (1, "2026-01-01"), (2, "2026-01-02")), path)
    store.write_partitions(rows("v int, date string", (3, "2026-01-02")), path, dynamic=True)
    got = {(r.v, str(r.date)) for r in readers.scan_partitioned(spark, path).collect()}
    assert got == {(1, "2026-01-01"), (3, "2026-01-02")}
    assert readers.scan_partitioned(spark, path, first="2026-01-02").count() == 1


def test_marker_moves_only_after_the_sink(spark, rows, tmp_path):
    """A take that fails after it has written is taken again under its number, so nothing is doubled or lost."""
    at = lambda *hours: rows("t timestamp", *[(dt(2026, 1, 1, h),) for h in hours])
    marker, out = str(tmp_path / "m"), str(tmp_path / "o")

    def write(new, number):
        store.write_batch(new, out, number)

    def write_and_fail(new, number):
        write(new, number)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        selection.take_new(spark, at(0, 11, 12), "t", marker, write_and_fail)
    assert store.batches(spark, out).count() == 2 and selection.last_take(spark, marker) == (None, 0)
    assert selection.take_new(spark, at(0, 11, 12), "t", marker, write)
    assert not selection.take_new(spark, at(0, 11, 12), "t", marker, write)
    with pytest.raises(InterruptedError):
        selection.take_new(spark, at(0, 11, 12, 13), "t", marker, write_and_fail)
    assert selection.take_new(spark, at(0, 11, 12, 13, 14), "t", marker, write)
    assert sorted((r.t.hour, r.batch) for r in store.batches(spark, out).collect()) == [(11, 0), (12, 0), (13, 1), (14, 1)]
    assert selection.last_take(spark, marker) == ("2026-01-01 14:00:00.000000", 2)


def test_control_rows(spark, tmp_path):
    p = str(tmp_path / "c")
    assert store.read_state(spark, p) == {} and store.publish_needed({}, window_end="x")
    store.write_state(spark, p, status="published", window_end="x")
    assert not store.publish_needed(store.read_state(spark, p), window_end="x")
    assert store.publish_needed(store.read_state(spark, p), window_end="y")


def test_latest_partitions_reject_gaps(rows):
    d = rows("date date", *[(date(2026, 1, i),) for i in (1, 2, 4, 5)])
    assert selection.latest_partitions(d, 2).count() == 2
    for bad in (3, 9):
        with pytest.raises(quality.QualityError):
            selection.latest_partitions(d, bad)


def test_lengths_and_global(rows):
    out = {r.segment_id: r.value for r in network.lengths_with_global(rows("segment_id string, length_ft double", ("a", 100.0), ("b", 200.4), ("c", 300.0))).collect()}
    assert out == {"a": 100, "b": 200, "c": 300, "GLOBAL": 200}
    assert network.lengths_with_global(rows("segment_id string, length_ft double")).isEmpty()


def test_tolls_add_up(rows, spark):
    m = rows("segment_id string, facility_key string, ordinal int", ("a", "bridge", 0), ("a", "late", 1), ("c", "none", 2))
    out = {r.segment_id: r.value for r in tolls.toll_values(m, rows("facility_key string, passenger double", ("bridge", 17.0), ("late", 5.0)), rows("segment_id string", ("a",), ("b",)), 0.75).collect()}
    assert out == {"a": 17.75, "b": 0.75}
    s = rows("segment_id string, street_name string", ("1", "big BRIDGE rd"), ("2", None), ("3", "x"))
    assert [r.segment_id for r in tolls.match_facilities(s, tolls.facility_table(spark, {"b": "bridge"})).collect()] == ["1"]


def test_readers(spark, tmp_path):
    (tmp_path / "n.csv").write_text('SegmentID,SHAPE\n1,"LINESTRING (0 0, 1 1)"\n,""\n')
    assert [tuple(r) for r in readers.read_string_csv(spark, str(tmp_path / "n.csv"), ["SegmentID", "SHAPE"]).collect()][0] == ("1", "LINESTRING (0 0, 1 1)")
    (tmp_path / "f.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"n":"x"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    assert len(readers.read_geojson(spark, str(tmp_path / "f.json")).first().parts[0]) == 4
    (tmp_path / "g.json").write_text('{"type":"Feature"}')
    with pytest.raises(quality.QualityError):
        readers.read_geojson(spark, str(tmp_path / "g.json"))
    (tmp_path / "z.csv").write_text('WKT,LocationID,borough\n"POLYGON ((0 0, 1 0, 1 1, 0 0))",7,Q\n')
    z = readers.read_zones(spark, str(tmp_path / "z.csv")).first()
    assert z.zone_id == 7 and len(z.parts[0]) == 4


def test_cache_and_export(spark, rows, tmp_path):
    built = []

    def build():
        built.append(1)
        return rows("id int", (1,))

    for _ in range(2):
        assert store.cached_table(spark, str(tmp_path / "c"), build).count() == 1
    assert built == [1]
    m = rows("k string, v double", ("0800", 1.0)).select(F.map_from_entries(F.array(F.struct("k", "v"))).alias("m"))
    store.export_json(m, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"m":{"0800":1.0}}'


@pytest.mark.parametrize("few", [0, 200])
def test_patterns_in_any_case_and_of_any_length(spark, rows, few):
    streets = ["Bridge St", "BRIDGE", "ridge", "a", "", "Éa", "éA", "x.y", "xzy", "tunnel road", "TUNNEL ROAD", "(odd)"]
    pats = ["bridge", "A", "ea", "éa", "x.y", "nel r", "^tun", "tunnel road and more", "(odd|even)", "idg", "BR"]
    s = rows("segment_id string, street_name string", *[(str(i), t) for i, t in enumerate([*streets, None, "BRIDGE"])])
    f = rows("ordinal int, facility_key string, street_contains string", *[(i, f"f{i}", p) for i, p in enumerate(pats)], (99, "none", None))
    got = {(r.segment_id, r.facility_key, r.ordinal) for r in tolls.match_facilities(s, f, few=max(few, 4)).collect()}
    want = {(str(i), f"f{k}", k) for i, t in enumerate([*streets, "", "BRIDGE"]) for k, p in enumerate(pats) if i != 12 and re.search(p, t, re.IGNORECASE | re.ASCII)}
    assert got == want


def test_many_patterns_need_no_nested_loop(spark):
    streets = spark.range(2000).select(F.col("id").cast("string").alias("segment_id"), F.concat(F.lit("Street no. "), F.col("id") * 37 % 5000, F.lit(" West")).alias("street_name"))
    f = spark.range(100_000).select(F.col("id").cast("int").alias("ordinal"), F.concat(F.lit("f"), "id").alias("facility_key"), F.concat(F.lit("NO- "), F.col("id"), F.lit(" w")).alias("street_contains"))
    f = f.withColumn("street_contains", F.translate("street_contains", "-", "")).withColumn("street_contains", F.regexp_replace("street_contains", "^NO ", " "))
    out = tolls.match_facilities(streets, f)
    got = {(r.segment_id, r.ordinal) for r in out.collect()}
    assert got == {(str(i), i * 37 % 5000) for i in range(2000)}
    with pytest.raises(ValueError, match="regular-expression"):
        tolls.match_facilities(streets, f.withColumn("street_contains", F.concat("street_contains", F.lit("+"))))


def test_profiles_of_parts_equal_that_of_the_whole(spark):
    """Twelve parts of unlike sizes and ranges, merged from stored sketches; nulls and NaN count nowhere."""
    v = F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 89 == 0, float("nan")).otherwise(F.pow(F.col("id"), F.lit(1.5)))
    df = spark.range(40_000).select(v.alias("v"), (F.col("id") % 7).alias("w"), F.floor(F.sqrt("id") / 17).alias("part"))
    sketches = quality.profile_sketches(df, ["v", "w"], ["part"])
    assert sketches.select("part").distinct().count() == 12
    got = {r.column_name: r for r in quality.merged_profile(sketches).collect()}
    values = sorted(r.v for r in df.filter("v IS NOT NULL AND NOT isnan(v)").collect())
    assert (got["v"].n, got["v"].min, got["v"].max, got["w"].n) == (len(values), values[0], values[-1], 40_000)
    for name, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        assert abs(sum(x <= got["v"][name] for x in values) / len(values) - share) <= quality.SKETCH_ERROR
    assert (got["w"].p50, got["w"].p99) == (3, 6)
    assert quality.merged_profile(quality.profile_sketches(df.limit(0), ["v"], ["part"])).collect() == []


def test_areas_of_several_polygons(spark, tmp_path):
    square = lambda x: f"[[[{x},0],[{x + 1},0],[{x + 1},1],[{x},0]]]"

    def write(*shapes):
        features = ",".join(f'{{"type":"Feature","properties":{{"k":"v"}},"geometry":{g}}}' for g in shapes)
        (tmp_path / "f.json").write_text(f'{{"type":"FeatureCollection","features":[{features}]}}')
        return readers.read_geojson(spark, str(tmp_path / "f.json"))

    got = write(f'{{"type":"MultiPolygon","coordinates":[{square(0)},{square(5)}]}}', f'{{"type":"Polygon","coordinates":{square(9)}}}').collect()
    assert [(r.feature, len(r.parts), r.parts[-1][0].x) for r in sorted(got)] == [(0, 2, 5.0), (1, 1, 9.0)]
    for other in ('{"type":"Point","coordinates":[1,2]}', "null"):
        with pytest.raises(quality.QualityError, match="no areas"):
            write(f'{{"type":"Polygon","coordinates":{square(9)}}}', other)
