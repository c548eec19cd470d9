"""The served slots as lists of a segment, and segments dealt into parts that share links."""

from datetime import date
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewright.operators import quality, store, traveltime
from lanewright.plans import jobs

READ = "link_id string, speed double, observed_at timestamp"
BATCH = "segment_id string, k array<tinyint>, value array<double>, t array<bigint>"
AT = [dt(2026, 8, 1, 0, 5), dt(2026, 8, 1, 0, 35), dt(2026, 8, 2, 1, 1)]


def as_set(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def batch_of(rows, *cells):
    """(segment, slot's number, value, time) as a batch of lists and as rows."""
    micros = lambda x: int(x.timestamp()) * 1_000_000
    segments = dict.fromkeys(c[0] for c in cells)
    lists = rows(BATCH, *[(s, *[[f(c) for c in cells if c[0] == s] for f in (lambda c: c[1], lambda c: c[2], lambda c: micros(c[3]))]) for s in segments])
    return lists, rows("segment_id string, time string, value double, last_sample_at timestamp", *[(s, traveltime.ts.SLOTS[k], v, at) for s, k, v, at in cells])


def test_lists_merge_as_rows_do(spark, rows, tmp_path):
    """New, moved, replayed and restarted slots, unknown values, segments and slots of one side alone, labels of no slot, other columns."""
    state = rows(
        "segment_id string, time string, value double, last_sample_at timestamp, avg double, count bigint, avg_formula_version string, updated_date date, note string",
        ("a", "0000", 10.0, AT[1], 10.0, 3, "old", date(2026, 1, 1), "x"), ("a", "0030", 10.0, AT[0], 10.0, 30, "old", date(2026, 1, 2), None), ("a", "0100", 9.0, None, 8.0, None, None, None, "y"),
        ("a", "0130", 9.0, AT[0], None, 2, "old", None, "z"), ("a", "0200", 9.0, AT[0], None, None, None, None, None), ("a", "noon", 7.0, AT[0], 7.0, 1, None, None, "odd"), ("a", None, 7.0, AT[0], 7.0, 1, None, None, "none"),
        ("b", "0000", 10.0, AT[0], 10.0, 3, "old", date(2026, 1, 1), "x"), (None, "0000", 1.0, AT[0], 1.0, 1, None, None, None),
    )
    new = [("a", 0, 25.0, AT[1]), ("a", 1, 25.0, AT[2]), ("a", 2, 26.0, AT[2]), ("a", 3, 27.0, AT[0]), ("a", 4, 28.0, AT[0]), ("a", 47, 12.0, AT[2]), ("a", 5, None, AT[2]), ("c", 7, 3.0, AT[1])]
    lists, plain = batch_of(rows, *new)
    path = str(tmp_path / "t")
    for known in (state, state.select("segment_id", "time", "avg", "count", "last_sample_at")):
        store.publish(known, path)
        want = store.upsert(known, traveltime.running_mean(plain, known, "2026-08-26"), traveltime.READING_KEYS)
        for n in range(2):
            got, layout = traveltime.merge_lists(lists, *traveltime.stored_lists(spark, path), "2026-08-26")
            store.publish(got, path, cube=layout)
            found = store.current(spark, path)
            assert found.columns == want.columns and as_set(found) == as_set(want)
            assert [f.dataType for f in found.schema] == [f.dataType for f in want.schema]
            # the second time the state is one of lists, and its own rows are not collected
            want = store.upsert(found, traveltime.running_mean(plain, found, "2026-08-26"), traveltime.READING_KEYS)


def test_published_slots_are_a_row_a_segment(spark, rows, tmp_path):
    """Slots of a segment meet as one row, nothing is sorted or shuffled by slot, and only the version before stays."""
    raw = "link_id string, speed string, link_points string, data_as_of string"
    feeds = [rows(raw, *[("l", f"{30 + d}", "1,2", f"2026-08-{d:02d} {h:02d}:10:00") for h in range(24)]) for d in (1, 2, 3)]
    links, lengths = rows("link_id string, segment_id string", ("l", "a"), ("l", "b"), ("l", "b")), rows("segment_id string, length_ft double", ("a", 5280.0), ("b", 2640.0), ("z", 1.0))
    path = str(tmp_path / "t")
    jobs.travel_times(spark, feeds, links, lengths, path, "2026-08-26", once=True)
    kept = store.versions(spark, path)
    assert len(kept) == 2 and {spark.read.parquet(f"{path}/versions/{v}").count() for v in kept} == {2}
    found = store.current(spark, path)
    assert found.count() == 48 and {(r["count"], r.segment_id, r.avg) for r in found.collect()} == {(3, "a", 112.0), (3, "b", 56.0)}
    got, _ = traveltime.merge_lists(batch_of(rows, ("a", 0, 1.0, AT[0]))[0], *traveltime.stored_lists(spark, path), "2026-08-26")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "hashpartitioning(segment_id" in plan and "time#" not in plan.split("hashpartitioning(", 1)[1].split(")")[0]


def test_times_that_are_not_positive_stop_the_job(spark, rows, tmp_path):
    raw = rows("link_id string, speed string, link_points string, data_as_of string", ("l", "30", "1,2", "2026-08-01 12:34:00"))
    links = rows("link_id string, segment_id string", ("l", "a"), ("l", "b"))
    path = str(tmp_path / "t")
    with pytest.raises(quality.QualityError):
        jobs.travel_time(spark, raw, links, rows("segment_id string, length_ft double", ("a", 0.0), ("b", 5280.0)), path, "2026-08-26")
    assert store.current(spark, path) is None
    jobs.travel_time(spark, raw, links, rows("segment_id string, length_ft double", ("a", None), ("b", 5280.0)), path, "2026-08-26")
    assert {(r.segment_id, r.value, r["count"]) for r in store.current(spark, path).collect()} == {("a", None, 1), ("b", 120.0, 1)}


def test_a_links_readings_go_to_few_parts(spark, rows, monkeypatch):
    """Groups of segments that share no links: however many there are, a link's readings go where its group is and nowhere else."""
    monkeypatch.setattr(traveltime, "LEAST_PAIRS", 40)
    monkeypatch.setattr(traveltime, "PART_PAIRS", 40)
    monkeypatch.setattr(traveltime, "GATHERED_PAIRS", 100)
    groups, segments, links = 12, 20, 5
    pairs = [(f"l{g}-{(s + i) % links}", f"s{g}-{s}") for g in range(groups) for s in range(segments) for i in range(3)]
    read = rows(READ, *[(f"l{g}-{i}", 20.0 + g + i, dt(2026, 8, 1 + i, i, 7 * g % 60)) for g in range(groups) for i in range(links)])
    plan = traveltime.link_plan(rows("link_id string, segment_id string", *pairs), once=True)
    assert plan.count() >= groups
    sent = traveltime._at_parts(read, plan).groupBy("link").agg(F.count_distinct("of").alias("n")).collect()
    # 60 pairs a group make two parts of it
    assert len(sent) == groups * links and max(r.n for r in sent) <= 2
    dealt = [s for r in plan.collect() for s in r.segments]
    assert len(dealt) == len(set(dealt)) == groups * segments
    assert sum(sum(r.sizes) for r in plan.collect()) == len(pairs)
    key = lambda df: sorted((r.segment_id, r.time, round(r.avg_speed, 9), r.last_observed_at) for r in df.collect())
    links_df = rows("link_id string, segment_id string", *pairs)
    assert key(traveltime.fanned_slot_means(read, links_df)) == key(traveltime.slot_means(traveltime.fan_out(read, links_df)))


def test_means_are_summed_in_time_order(rows):
    """To the last bit as the plain operator: a sum in another order may fall to the other side of a half second."""
    read = rows(READ, *[(f"l{i % 3}", 1.0 + i * 7919 % 9973 / 100, dt(2026, 8, 1 + i // 60, i % 12, i % 60)) for i in range(1500)])
    links = rows("link_id string, segment_id string", *[(f"l{i}", s) for s in "ab" for i in range(3)])
    key = lambda df: sorted((r.segment_id, r.time, r.avg_speed) for r in df.collect())
    assert key(traveltime.fanned_slot_means(read, links)) == key(traveltime.slot_means(traveltime.fan_out(read, links)))
