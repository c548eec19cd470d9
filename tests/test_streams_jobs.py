import time
from datetime import date, timedelta
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewright import scratch
from lanewright.functions import geometry as geo
from lanewright.operators import demand, network, quality, spatial, store, tolls, traveltime
from lanewright.plans import jobs
from lanewright.sources import selection
from lanewright.streaming import streams

VALUES = "segment_id string, time string, value double, last_sample_at timestamp"


def fold(spark, src, table, log, **how):
    streams.fold_means(streams.read_landed(spark, src, VALUES), table, log, **how).awaitTermination()
    return {(r.segment_id, r.time): (r.avg, r["count"], r.last_sample_at, r.late) for r in store.newest_of_batches(spark, table, ["segment_id", "time"]).collect()}


def test_running_means_go_on_from_their_checkpoint(spark, rows, tmp_path):
    """Each landing is taken by a new run; a run writes only the keys that moved, and its provider setting does not stay."""
    src, table, log = (str(tmp_path / x) for x in ("in", "means", "log"))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    h = [("a", "0800", 30.0, dt(2026, 8, 1)), ("b", "0900", 7.0, dt(2026, 8, 1)), ("a", "0800", 60.0, dt(2026, 8, 2)), ("a", "0800", 90.0, dt(2026, 8, 3))]
    for part in (h[:2], h[2:3], h[3:]):
        rows(VALUES, *part).write.mode("append").parquet(src)
        got = fold(spark, src, table, log)
    want = {(r.segment_id, r.time): (r.avg, r["count"]) for r in traveltime.replay_means(rows(VALUES, *h), ["segment_id", "time"]).collect()}
    assert {k: v[:2] for k, v in got.items()} == want == {("a", "0800"): (60, 3), ("b", "0900"): (7, 1)}
    assert [{r.segment_id for r in store.batches(spark, table).filter(f"batch = {n}").collect()} for n in range(3)] == [{"a", "b"}, {"a"}, {"a"}]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_late_samples_count_and_repeats_do_not(spark, rows, tmp_path):
    src, table, log = (str(tmp_path / x) for x in ("in", "means", "log"))
    days = [[(30.0, 2)], [(60.0, 1)], [(60.0, 1), (30.0, 2)], [(None, 3), (90.0, 2)]]
    for part in days:
        rows(VALUES, *[("a", "0800", v, dt(2026, 8, d)) for v, d in part], (None, "0800", 1.0, dt(2026, 8, 9))).write.mode("append").parquet(src)
        got = fold(spark, src, table, log)
    assert got == {("a", "0800"): (45, 2, dt(2026, 8, 2), 1)}


def test_a_key_without_samples_is_forgotten(spark, rows, tmp_path):
    """After its time to live a key starts anew; the stream runs at an interval and is stopped."""
    src, table = str(tmp_path / "in"), str(tmp_path / "t")
    rows(VALUES, ("a", "0800", 30.0, dt(2026, 8, 1))).write.parquet(src)
    q = streams.fold_means(streams.read_landed(spark, src, VALUES), table, str(tmp_path / "log"), every="1 second", ttl=timedelta(milliseconds=1))

    def wait_for(avg):
        until = time.time() + 40
        while time.time() < until:
            found = store.batches(spark, table)
            if found is not None and not found.filter(F.col("avg") == avg).isEmpty():
                return found.filter(F.col("avg") == avg).first()["count"]
            time.sleep(0.5)

    try:
        assert wait_for(30.0) == 1
        rows(VALUES, ("a", "0800", 90.0, dt(2026, 8, 2))).write.mode("append").parquet(src)
        assert wait_for(90.0) == 1
    finally:
        q.stop()


def test_rounding_is_half_to_even_at_each_step(spark, rows, tmp_path):
    h = [("a", "0800", v, dt(2026, 8, 1 + i)) for i, v in enumerate((2.5, 3.5, 0.5, 1.5, -2.5, 7.25, 100.0, 3.0, 4.0, 5.0, 6.0, 9.5, 200.0))]
    src = str(tmp_path / "in")
    rows(VALUES, *h).write.parquet(src)
    got = fold(spark, src, str(tmp_path / "t"), str(tmp_path / "log"))
    want = traveltime.replay_means(rows(VALUES, *h), ["segment_id", "time"]).first()
    assert got["a", "0800"][:2] == (want.avg, want["count"])


def test_rows_behind_the_watermark_are_kept_apart(spark, rows, tmp_path):
    src, out, closed = (str(tmp_path / x) for x in ("in", "out", "closed"))
    landed = [[("a", 1.0, dt(2026, 8, 1, 12)), ("b", 2.0, dt(2026, 8, 1, 4))], [("a", 1.0, dt(2026, 8, 1, 12)), ("a", 3.0, dt(2026, 8, 1, 6)), ("a", 5.0, dt(2026, 8, 1, 5)), ("a", 9.0, None)], [("a", 7.0, dt(2026, 8, 2))]]
    for part in landed:
        rows(streams.READINGS, *part).write.mode("append").parquet(src)
        streams.route_late(streams.read_landed(spark, src, streams.READINGS), out, str(tmp_path / "l1")).awaitTermination()
        q = streams.closed_windows(streams.read_landed(spark, src, streams.READINGS), closed, str(tmp_path / "l2"), ["segment_id"])
        q.awaitTermination()
    got = store.batches(spark, f"{out}/rows").collect()
    assert sorted((r.speed, r.late) for r in got) == [(1, False), (1, False), (2, False), (3, True), (5, True), (7, False), (9, True)]
    assert sorted((r.segment_id, r.bucket, r.speed, r.readings) for r in store.batches(spark, closed).collect()) == [("a", dt(2026, 8, 1, 12), 1, 1), ("b", dt(2026, 8, 1, 4), 2, 1)]


def test_a_batch_that_comes_again_replaces_itself(spark, rows, tmp_path):
    p = str(tmp_path / "b")
    assert store.batches(spark, p) is None
    store.write_batch(rows("k string, v int", ("a", 1), ("b", 1)), p, 0)
    for v in (7, 8):
        store.write_batch(rows("k string, v int", ("a", v)), p, 1)
    (tmp_path / "b" / "batch=1" / "_SUCCESS").rename(tmp_path / "b" / "kept")  # as if the write had not ended
    assert {(r.k, r.v) for r in store.newest_of_batches(spark, p, ["k"]).collect()} == {("a", 1), ("b", 1)}
    (tmp_path / "b" / "kept").rename(tmp_path / "b" / "batch=1" / "_SUCCESS")
    assert {(r.k, r.v) for r in store.newest_of_batches(spark, p, ["k"]).collect()} == {("a", 8), ("b", 1)}
    assert store.batches(spark, p).count() == 3 and store.batches_before(spark, p, 1).count() == 2


def test_travel_time_job(spark, rows, tmp_path):
    raw = rows("link_id string, speed string, link_points string, data_as_of string", ("l", "30", "1,2 3,4", "2026-08-01 12:34:00"), ("l", None, "1,2", "2026-08-01 12:34:00"))
    m, n = rows("link_id string, segment_id string", ("l", "a"), ("l", "b")), rows("segment_id string, length_ft double", ("a", 5280.0), ("b", 2640.0))
    for _ in range(2):
        snap = jobs.travel_time(spark, raw, m, n, str(tmp_path / "t"), "2026-08-26")
    got = {r.segment_id: r.slots["1230"].avg for r in snap.collect()}
    assert got == {"a": 120, "b": 60}
    assert {r["count"] for r in store.current(spark, str(tmp_path / "t")).collect()} == {1}


def test_demand_jobs(spark, rows, tmp_path):
    zones = rows("zone_id int", (1,))
    t = rows("pickup_datetime timestamp, pickup_location_id int", *[(dt(2026, 2, 1) + timedelta(d), 1) for d in range(28)])
    live = str(tmp_path / "live")
    jobs.daily_cube(spark, t, "2026-02", zones, str(tmp_path / "stage"), live)
    m = rows("segment_id string, zone_id int", ("a", 1), ("b", 1))
    assert jobs.rolling_publish(spark, live, m, 4, str(tmp_path / "seg"), str(tmp_path / "state"))
    assert not jobs.rolling_publish(spark, live, m, 4, str(tmp_path / "seg"), str(tmp_path / "state"))
    assert store.current(spark, str(tmp_path / "seg")).count() == 2 * 336
    with pytest.raises(quality.QualityError):
        jobs.daily_cube(spark, t.filter(F.col("pickup_datetime") != dt(2026, 2, 9)), "2026-02", zones, str(tmp_path / "stage2"), live)


def test_trip_intake_routes_each_kind(rows, tmp_path):
    good = rows("pickup_datetime timestamp, dropOff_datetime timestamp, PUlocationID int, DOlocationID int", *[(dt(2026, 1, 1), dt(2026, 1, 1), 3, 4)] * 9, (dt(2026, 1, 1), None, 3, 4))
    out = jobs.intake_trips({"fhv": good, "green": good}, str(tmp_path))
    assert out["fhv"] == "passed" and out["green"].startswith("excluded")


def test_reading_intake_leaves_the_marker_when_blocked(spark, rows, tmp_path):
    ddl = "link_id string, speed string, data_as_of string"
    net, marker, out = rows("segment_id string, speed_limit int", ("a", 30), ("b", 30)), str(tmp_path / "m"), str(tmp_path / "o")
    bad = rows(ddl, ("a", "x", "2026-01-01 00:01:00"), ("b", "9", "2026-01-01 00:02:00"))
    with pytest.raises(quality.QualityError):
        jobs.intake_readings(spark, bad, net, ["speed"], marker, out, "2026-01-02")
    assert selection.last_take(spark, marker) == (None, 0)
    assert jobs.intake_readings(spark, bad.filter("speed = '9'"), net, ["speed"], marker, out, "2026-01-02")
    assert store.batches(spark, out).count() == 2


def test_network_zone_toll_jobs(spark, rows, tmp_path):
    raw = rows("SegmentID string, Street string, SHAPE_Length string, LBoro string, NodeIDFrom string, NodeIDTo string, SHAPE string, POSTED_SPEED string", *[(f" {i} ", " a  bridge " if i == 1 else "road", "100", "1", "n1", "n2", f"LINESTRING ({i} 0.2, {i} 0.8)", "25") for i in (0, 1, 1)])
    dim = jobs.network_dimension(spark, raw, str(tmp_path / "dim"), (1, 10))
    assert {r.segment_id: r.street_name for r in dim.collect()} == {"0": "ROAD", "1": "A BRIDGE"}
    zones = rows("zone_id int, borough string, w string", (1, "q", "POLYGON ((-1 -1, 3 -1, 3 3, -1 3, -1 -1))")).select("zone_id", "borough", geo.wkt_parts(F.col("w")).alias("parts"))
    m = jobs.zone_mapping(spark, dim, zones, str(tmp_path / "map"), str(tmp_path / "mv"), cell=1.0)
    assert m.count() == 2 and store.read_state(spark, str(tmp_path / "mv"))["version"].startswith("2-")
    t = jobs.toll_table(spark, dim, zones, tolls.facility_table(spark, {"b": "bridge"}), tolls.rate_table(spark, {"b": 6.0}), 0.75, str(tmp_path / "toll"))
    assert {r.segment_id: r.value for r in t.collect()} == {"0": 0.75, "1": 6.75}
    report = jobs.length_table(spark, dim, str(tmp_path / "len")).first()
    assert report.stale_keys == 0
    report = jobs.length_table(spark, dim.filter("segment_id = '0'"), str(tmp_path / "len")).first()
    assert report.deleted_rows == 1
    assert {r.segment_id for r in store.current(spark, str(tmp_path / "len")).collect()} == {"0", "GLOBAL"}
    assert jobs.posted_speeds(raw).count() == 2
    assert jobs.network_profile(raw, ["length_ft"])[0].first().duplicate_keys == 1


def test_route_job(spark, rows):
    r = rows("route_id long, segments array<string>, type int, date string, time string", (1, ["a", "b"], 2, "2026-08-26", "08:00"), (2, ["a"], 7, "2026-08-26", "08:00"))
    empty = lambda ddl: rows(ddl)
    scored, tiers = jobs.score_routes(r, empty("segment_id string, time string, value double, avg double, last_sample_at timestamp"), rows("segment_id string, value double", ("a", 9.0), ("GLOBAL", 5.0)), None, empty("segment_id string, zone_id int"), empty("zone_id int, dow string, time string, value double"), empty("segment_id string, value double"), "2026-08-26")
    assert sorted((x.route_id, x.pos, x.value, x.source) for x in scored.collect()) == [(1, 0, 9, "rds"), (1, 1, 5, "global"), (2, 0, 45, "hardcoded")]
    assert {x.route_id: x.terminal_ratio for x in tiers.collect()} == {1: 0, 2: 1}


def _live(spark, rows, tmp_path):
    live = str(tmp_path / "live")
    t = rows("pickup_datetime timestamp, pickup_location_id int", *[(dt(2026, 2, 1) + timedelta(d), 1) for d in range(28)])
    jobs.daily_cube(spark, t, "2026-02", rows("zone_id int", (1,)), str(tmp_path / "stage"), live)
    return live


def test_rolling_publish_again_after_it_failed_on_the_way(spark, rows, tmp_path, monkeypatch):
    live, m = _live(spark, rows, tmp_path), rows("segment_id string, zone_id int", ("a", 1))
    args = (spark, live, m, 4, *(str(tmp_path / x) for x in ("seg", "state", "export")))
    with pytest.raises(quality.QualityError):
        jobs.rolling_publish(spark, live, m.limit(0), *args[3:])
    with monkeypatch.context() as patch:

        def lost(*_):
            raise InterruptedError

        patch.setattr(store, "export_json", lost)
        with pytest.raises(InterruptedError):
            jobs.rolling_publish(*args)
    assert store.read_state(spark, args[5]) == {}
    before = list(scratch._written)
    assert jobs.rolling_publish(*args) and not jobs.rolling_publish(*args)
    assert scratch._written == before  # nothing of the runs is left
    assert spark.read.json(args[6]).count() == 336 and store.current(spark, args[4]).count() == 336
    bad = rows("segment_id string, zone_id int", ("a", 1), ("a", 1))
    with pytest.raises(quality.QualityError, match="mapping_repeats"):
        jobs.rolling_publish(spark, live, bad, *args[3:])
    assert store.read_state(spark, args[5])["mapping_hash"].startswith("1-")


def test_only_ready_months_are_built_once(spark, rows, tmp_path):
    zones, live = rows("zone_id int", (1,)), str(tmp_path / "live")
    t = rows("pickup_datetime timestamp, pickup_location_id int", *[(dt(2026, 2, 1) + timedelta(d), 1) for d in range(59)])
    manifest = rows("month string, kind string, path string, done boolean", ("2026-02", "a", "p", True), ("2026-03", "a", "q", True), ("2026-03", "b", "r", True), ("2026-02", "b", "s", False))
    kinds = rows("kind string", ("a",), ("b",))
    assert jobs.monthly_cubes(spark, manifest, kinds, t, zones, str(tmp_path / "stage"), live) == ["2026-03"]
    assert jobs.monthly_cubes(spark, manifest, kinds, t, zones, str(tmp_path / "stage"), live, rows("month string", ("2026-03",))) == []
    assert spark.read.parquet(live).select("date").distinct().count() == 31


def test_contracts_of_empty_tables(rows):
    rules = lambda df: {r.rule: r.n for r in df.collect()}
    assert rules(network.network_violations(rows("segment_id string, borough_code string, is_suspect boolean"), (3, 9), 0.05)) == {"row_count_off": 3}
    empty = rows("segment_id string, zone_id int, mapping_method string, is_suspect boolean")
    assert rules(spatial.mapping_violations(empty, rows("segment_id string", ("a",), ("a",), ("b",)), (1, 263), 0.1)) == {"missing_segments": 2}
    assert rules(spatial.mapping_violations(empty, rows("segment_id string"), (1, 263), 0.1)) == {}
    assert rules(spatial.zone_violations(rows("zone_id int, parts array<array<struct<x: double, y: double>>>"), (1, 5))) == {"count_off": 1}
    assert rules(spatial.zone_violations(rows("zone_id int, parts array<array<struct<x: double, y: double>>>", (1, [[]]), (2, None)), (1, 5))) == {"open_rings": 1, "without_border": 1}


def test_a_reading_without_a_time_is_in_no_slot(spark, rows, tmp_path):
    raw = rows("link_id string, speed string, link_points string, data_as_of string", ("l", "30", "1,2 3,4", "2026-08-01 12:34:00"), ("l", "30", "1,2 3,4", "yesterday"))
    m, n = rows("link_id string, segment_id string", ("l", "a")), rows("segment_id string, length_ft double", ("a", 5280.0))
    for _ in range(2):
        jobs.travel_time(spark, raw, m, n, str(tmp_path / "t"), "2026-08-26")
    assert [r.time for r in store.current(spark, str(tmp_path / "t")).collect()] == ["1230"]
