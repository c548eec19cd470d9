from datetime import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lanewright.functions import timeslot as ts
from lanewright.functions import values as val
from lanewright.operators import routes, traveltime

READ = "segment_id string, speed double, observed_at timestamp"


def one(df):
    return df.first().asDict()


def test_a_mile_at_thirty_takes_two_minutes(rows):
    r = rows(READ, ("s", 30.0, dt(2026, 8, 1, 12, 34)))
    out = one(traveltime.slot_seconds(r, rows("segment_id string, length_ft double", ("s", 5280.0))))
    assert (out["time"], out["time_seconds"], out["last_observed_at"]) == ("1230", 120.0, dt(2026, 8, 1, 12, 34))


def test_newer_readings_weigh_more_and_days_share_a_slot(rows):
    r = rows(READ, ("s", 10.0, dt(2026, 8, 1, 0, 5)), ("s", 30.0, dt(2026, 8, 2, 0, 10)))
    out = one(traveltime.slot_means(r))
    assert out["avg_speed"] == pytest.approx(70 / 3)
    assert out["last_observed_at"] == dt(2026, 8, 2, 0, 10)


def test_speed_zero_gives_no_time(rows):
    r = rows(READ, ("s", 0.0, dt(2026, 8, 1)))
    assert traveltime.slot_seconds(r, rows("segment_id string, length_ft double", ("s", 1.0))).isEmpty()


def test_length_zero_is_reported(rows):
    s = rows("segment_id string, time_seconds double", ("a", 0.0), ("b", 1.0))
    assert [r.segment_id for r in traveltime.not_positive(s).collect()] == ["a"]


def test_running_mean_sequence(rows):
    kind = "segment_id string, time string, value double, last_sample_at timestamp"
    state = rows(kind + ", avg double, count long").limit(0) if False else rows("segment_id string, time string, avg double, count long, last_sample_at timestamp")
    seen = []
    for value, day in ((30.0, 1), (60.0, 2), (60.0, 2), (90.0, 3)):
        out = traveltime.running_mean(rows(kind, ("s", "0800", value, dt(2026, 8, day))), state, "2026-08-26")
        r = one(out)
        seen.append((r["avg"], r["count"]))
        state = rows("segment_id string, time string, avg double, count long, last_sample_at timestamp", ("s", "0800", r["avg"], r["count"], r["last_sample_at"]))
    assert seen == [(30, 1), (45, 2), (45, 2), (60, 3)]
    assert r["avg_formula_version"].startswith("v1+") and len(r["avg_formula_version"]) == 9


@pytest.mark.parametrize("count, avg, want", [(10, 60.0, (74.0, 11)), (None, 500.0, (200.0, 1)), (0, 500.0, (200.0, 1))])
def test_running_mean_cap_and_reset(rows, count, avg, want):
    new = rows("segment_id string, time string, value double, last_sample_at timestamp", ("s", "0800", 200.0, dt(2026, 8, 9)))
    state = rows("segment_id string, time string, avg double, count long, last_sample_at timestamp", ("s", "0800", avg, count, dt(2026, 8, 1)))
    r = one(traveltime.running_mean(new, state, "2026-08-26"))
    assert (r["avg"], r["count"]) == want


def test_replay_equals_merges(rows):
    h = rows("k string, value double, last_sample_at timestamp", ("a", 30.0, dt(2026, 8, 1)), ("a", 90.0, dt(2026, 8, 3)), ("a", 60.0, dt(2026, 8, 2)), ("a", 60.0, dt(2026, 8, 2)))
    r = one(traveltime.replay_means(h, ["k"]))
    assert (r["avg"], r["count"]) == (60, 3)


def test_unparsable_readings_are_suspect(rows):
    r = rows("speed string, data_as_of string", ("12", "2026-01-01 00:00:00"), ("-5", "2026-01-01 00:00:00"), ("x", "2026-01-01 00:00:00"), ("12", "1930-01-01 00:00:00"), (None, None))
    got = [x.s for x in r.select(traveltime.reading_suspect(F.lit("2026-06-01").cast("timestamp")).alias("s")).collect()]
    assert got == [False, True, True, True, True]


def test_gaps_are_filled_with_bounded_speeds(rows):
    net = rows("segment_id string, speed_limit int", ("a", 40), ("b", None), ("c", 0))
    out = traveltime.fill_buckets(rows(READ, ("a", 20.0, dt(2026, 8, 1, 0, 5)), ("b", 20.0, dt(2026, 8, 1, 0, 40))), net).filter("synthetic").collect()
    assert {(r.segment_id, r.observed_at.minute) for r in out} == {("b", 5), ("c", 5), ("a", 40), ("c", 40)}
    for r in out:
        base = 40 if r.segment_id == "a" else 25
        assert 0.3 * base <= r.speed <= 1.3 * base


def test_backfill_leaves_count_open(rows):
    net = rows("segment_id string, length_ft double, speed_limit int", ("a", 5280.0, 30), ("b", -1.0, 30))
    live = rows("segment_id string, time string", ("a", "0000"))
    out = traveltime.backfill_slots(net, live)
    assert out.count() == 47
    assert one(out)["avg"] == 120.0 and one(out)["count"] is None


SLOTS = "segment_id string, time string, value double, avg double, last_sample_at timestamp"


def requests(rows, *segments):
    return rows("route_id long, pos long, segment_id string, type int, date string, time string", *[(1, i, s, 1, "2026-08-26", "08:00") for i, s in enumerate(segments)])


def test_route_time_moves_the_clock(rows):
    today, old = dt(2026, 8, 26, 7), dt(2026, 8, 25, 7)
    slots = rows(SLOTS, ("a", "0800", 1800.0, None, today), ("b", "0800", 5.0, None, today), ("b", "0830", 999.0, 1.0, today), ("a", "0830", 10.0, 77.0, old))
    vals = [r.value for r in routes.score_time(requests(rows, "a", "b"), slots, "2026-08-26").orderBy("pos").collect()]
    assert vals == [1800, 999]
    out = routes.score_time(requests(rows, "a", "a", "zz"), slots, "2026-08-26").orderBy("pos").collect()
    assert [r.value for r in out] == [1800, 77, 45]
    assert [r.token for r in out] == ["rds:observed", "rds:historical_average", "code:static_default"]


def test_route_time_wraps_at_midnight(rows):
    slots = rows(SLOTS, ("a", "2330", 1800.0, 1800.0, dt(2026, 8, 1)), ("b", "0000", None, 7.0, None))
    r = requests(rows, "a", "b").withColumn("time", F.lit("23:45"))
    assert [x.value for x in routes.score_time(r, slots, "2026-08-26").orderBy("pos").collect()] == [1800, 7]


def test_bad_clock_still_gets_a_value(rows):
    r = requests(rows, "a").withColumn("time", F.lit("late"))
    assert routes.score_time(r, rows(SLOTS), "2026-08-26").first().value == 45


def test_static_and_toll_fallbacks(rows):
    r = requests(rows, "a", "b")
    lengths = rows("segment_id string, value double", ("a", 120.0), ("GLOBAL", 200.0))
    assert [x.value for x in routes.score_static(r, lengths).orderBy("pos").collect()] == [120, 200]
    none = routes.score_static(r, lengths.filter("segment_id = 'a'")).orderBy("pos").collect()
    assert [(x.value, x.token) for x in none] == [(120, "rds:segment_value"), (300, "rds:global_default")]
    snap = routes.score_static(r, lengths.limit(0), storage="s3_snapshot").orderBy("pos").collect()
    assert snap[1].token == "code:static_default"
    toll = routes.score_toll(r, rows("segment_id string, value double", ("b", 6.5))).orderBy("pos").collect()
    assert [(x.value, x.token) for x in toll] == [(0, "rds:implicit_zero"), (6.5, "rds:segment_value")]


def test_demand_falls_back_to_the_zone(rows):
    r = requests(rows, "a", "b", "c").withColumn("time", F.lit("09:15"))
    own = rows("segment_id string, dow string, time string, value double", ("a", "WED", "0900", 3.0))
    m = rows("segment_id string, zone_id int", ("a", 1), ("b", 1))
    z = rows("zone_id int, dow string, time string, value double", (1, "WED", "0900", 8.0))
    out = routes.score_demand(r, own, m, z).orderBy("pos").collect()
    assert [x.value for x in out] == [3.0, 8.0, 0.0]
    assert [x.value for x in routes.score_demand(r, None, m, z).orderBy("pos").collect()] == [8.0, 8.0, 0.0]


def test_request_validity(rows):
    r = rows("s array<string>, k int, d string, t string", (["a"], 1, "2026-01-01", "08:00"), ([], 1, "2026-01-01", "08:00"), (["a"], 9, "2026-01-01", "08:00"), (["a"], 1, "2026-13-01", "08:00"), (["a"], 1, "2026-01-01", "8am"))
    got = [x.v for x in r.select(routes.valid_request(F.col("s"), F.col("k"), F.col("d"), F.col("t")).alias("v")).collect()]
    assert got == [True, False, False, False, False]


def test_freshness_knows_offsets(rows):
    r = rows("s string", ("2026-08-26 01:00:00",), ("2026-08-27T03:00:00+00:00",), ("2026-08-26T03:00:00+00:00",), ("soon",), (None,))
    got = [x.v for x in r.select(ts.is_fresh(F.col("s"), F.lit("2026-08-26").cast("date")).alias("v")).collect()]
    assert got == [True, True, False, False, False]


def test_clock_and_text(rows):
    r = rows("c string, n string", ("23:50", "  Main   st "), ("x", " ")).select(
        ts.clock_plus(F.col("c"), F.lit(900)).alias("p"), ts.slot_of_clock(F.col("c")).alias("s"), val.clean_street(F.col("n")).alias("n"), val.number(F.col("n")).alias("v"), val.half_even(F.lit(2.5)).alias("h"), val.clock_text(F.lit("30")).alias("z")
    ).collect()
    assert tuple(r[0]) == ("00:05", "2330", "MAIN ST", None, 2.0, "0030")
    assert tuple(r[1])[:3] == (None, None, None)


def test_the_grid_of_gaps_is_made_and_not_shuffled(rows):
    """Repeated and null segments, a segment with every bucket, a reading without a time: each bucket without a reading is filled once."""
    net = rows("segment_id string, speed_limit int", ("a", 40), ("b", 30), ("b", 30), (None, 20))
    read = rows(READ, ("a", 20.0, dt(2026, 8, 1, 0, 5)), ("a", 21.0, dt(2026, 8, 1, 0, 7)), ("a", 20.0, dt(2026, 8, 1, 0, 40)), ("b", 20.0, dt(2026, 8, 1, 0, 41)), ("b", 9.0, None))
    out = traveltime.fill_buckets(read, net)
    made = [(r.segment_id, r.observed_at) for r in out.filter("synthetic").collect()]
    assert sorted(made, key=str) == sorted([("b", dt(2026, 8, 1, 0, 7))] * 2 + [(None, dt(2026, 8, 1, 0, 7)), (None, dt(2026, 8, 1, 0, 41))], key=str)
    assert out.count() == 9
    assert "LeftAnti" not in out._jdf.queryExecution().executedPlan().toString()
    counts = traveltime.gap_counts(read, net)
    assert sorted(((r.segment_id, r.gaps) for r in counts.collect()), key=str) == [("b", 1), ("b", 1), (None, 2)]
    assert "Generate explode(places" not in counts._jdf.queryExecution().executedPlan().toString()
    assert traveltime.fill_buckets(read.limit(0), net).isEmpty() and traveltime.gap_counts(read.limit(0), net).isEmpty()


def test_totals_are_fanned_out_by_link(rows):
    read = rows("link_id string, speed long", ("x", 3), ("x", 4), ("y", None), ("z", 1))
    links = rows("link_id string, segment_id int", ("x", 1), ("x", 2), ("y", 2), ("w", 3))
    out = {(r.segment_id, r.readings, r.total) for r in traveltime.fan_out_totals(read, links).collect()}
    assert out == {("1", 2, 7), ("2", 3, 7)}


def test_fanned_means_agree_with_the_means_of_fanned_readings(rows, monkeypatch):
    """Several links a segment and segments a link, a link mapped twice, ties in time, readings of two months; blocks are cut at any size."""
    at = lambda i: dt(2026, 7 + i % 2, 1 + i % 5, i % 3, 7 * i % 60)
    read = rows("link_id string, speed double, observed_at timestamp", *[(f"l{i % 4}", 1.0 + i * 37 % 50, at(i % 40)) for i in range(160)], ("l1", None, at(1)), ("l1", 5.0, None), ("gone", 9.0, at(1)))
    links = rows("link_id string, segment_id string", ("l0", "a"), ("l1", "a"), ("l1", "a"), ("l2", "b"), ("l3", "b"), ("l0", "c"), ("l9", "d"), ("l1", None))
    plain = traveltime.slot_means(traveltime.drop_slow(traveltime.fan_out(read, links)).filter("segment_id IS NOT NULL AND observed_at IS NOT NULL"))
    key = lambda df: sorted((r.segment_id, r.time, round(r.avg_speed, 9), r.last_observed_at) for r in df.collect())
    want = key(plain)
    assert want and key(traveltime.fanned_slot_means(read, links)) == want
    pairs = pa.table({"link_id": [r.link_id for r in links.collect() if r.segment_id and r.link_id != "l9"], "segment_id": [r.segment_id for r in links.collect() if r.segment_id and r.link_id != "l9"]})
    by = {}
    for r in read.dropna().collect():
        by.setdefault(r.link_id, []).append({"t": int(r.observed_at.timestamp()), "k": r.observed_at.hour * 2 + r.observed_at.minute // 30, "v": r.speed})
    table = pa.table({"link_id": list(by), "r": list(by.values())})
    whole = sorted(map(str, traveltime._block_means(pairs, table).to_pylist()))
    for n in (1, 70, 100, 200):
        monkeypatch.setattr(traveltime, "SORTED_READINGS", n)
        assert sorted(map(str, traveltime._block_means(pairs, table).to_pylist())) == whole
    assert len(whole) == len(want)
    assert traveltime.fanned_slot_means(read.limit(0), links).isEmpty()
