import pytest
from pyspark.sql import functions as F

from lanewright.operators import demand, quality, store
from lanewright.plans import jobs

WEEK = [(w, t) for w in demand.ts.WEEKDAYS for t in demand.ts.SLOTS]
ROLLED = "zone_id int, type int, dow string, time string, value double"


def _written(spark, path):
    return [spark.read.parquet(f"{path}/versions/{v}") for v in store.versions(spark, path)]


def test_a_segment_is_published_as_one_row_and_read_as_its_week(spark, rows, tmp_path):
    live, table = str(tmp_path / "live"), str(tmp_path / "table")
    dates = spark.sql("SELECT explode(sequence(DATE '2026-02-02', DATE '2026-03-01')) AS date")
    slots = rows("zone_id int, time string, i int", *[(z, t, i) for z in (1, 2) for i, t in enumerate(demand.ts.SLOTS)])
    daily = dates.crossJoin(slots).select("zone_id", F.lit(3).alias("type"), "date", "time", (F.col("zone_id") * 1000 + F.weekday("date") * 48 + F.col("i")).cast("double").alias("value"))
    store.write_partitions(daily, live)
    m = rows("segment_id string, zone_id int", ("a", 1), ("b", 2), ("c", 1))
    assert jobs.rolling_publish(spark, live, m, 4, table, str(tmp_path / "state"))
    (written,) = _written(spark, table)
    assert written.count() == 3  # not 3 * 336
    want = {(s, 3, w, t, 1000.0 * z + i) for s, z in (("a", 1), ("b", 2), ("c", 1)) for i, (w, t) in enumerate(WEEK)}
    got = store.current(spark, table)
    assert got.columns == ["segment_id", "type", "dow", "time", "value"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(quality.QualityError, match="duplicate_keys"):
        jobs.rolling_publish(spark, live, m.unionByName(rows("segment_id string, zone_id int", ("a", 2))), 4, table, str(tmp_path / "state"))
    assert sorted(map(tuple, store.current(spark, table).collect())) == sorted(want)


def test_packed_weeks_of_uneven_zones(rows):
    """Zones in any order; with a slot twice, one absent, one of another name, and one twice in place of another."""
    whole = [(w, t, float(i)) for i, (w, t) in enumerate(WEEK)]
    zones = {1: whole[::-1], 2: whole + whole[:1], 3: whole[1:], 4: [*whole[1:], ("MON", "0015", 1.0)], 5: [*whole[1:], whole[5]], 6: [*whole[1:], (None, "0000", 1.0)]}
    rolled = rows(ROLLED, *[(z, 3, *r) for z, v in zones.items() for r in v])
    lists = store.packed(rolled, demand.WEEK)
    assert {r.zone_id: r.value for r in lists.collect()} == {1: [float(i) for i in range(336)]} | dict.fromkeys(range(2, 7))
    assert sorted(map(tuple, store.unpacked(lists, demand.WEEK).collect())) == sorted((1, 3, *r) for r in whole)


@pytest.mark.parametrize("more", [[], [("a", 1)], [(None, 1), (None, 2)], [("q", 9), ("r", None), ("s", 4)]])
def test_lists_break_the_rules_that_their_rows_break(rows, more):
    """Zone 3 has values below 0 and none, zone 4 lacks a slot; segments that repeat, are null, or have no zone."""
    value = lambda z, i: None if z == 3 and i % 90 == 1 else -1.0 if z == 3 and i % 50 == 2 else float(i)
    rolled = rows(ROLLED, *[(z, 3, w, t, value(z, i)) for z in (1, 2, 3, 4) for i, (w, t) in enumerate(WEEK) if z < 4 or i])
    for zones in ([1, 2, 1], [1, 2, 3, 3, 3]):
        m = rows("segment_id string, zone_id int", *[(chr(97 + i), z) for i, z in enumerate(zones)], *more)
        weeks = demand.week_lists(rolled, m)
        got = {r.rule: r.n for r in demand.week_violations(weeks, m).collect()}
        assert got == {r.rule: r.n for r in demand.segment_violations(store.unpacked(weeks, demand.WEEK), m).collect()}
        if ("s", 4) not in more:
            assert got == {r.rule: r.n for r in demand.segment_violations(demand.expand_to_segments(rolled, m), m).collect()}
        assert ("negative_values" in got) == (3 in zones) and got.get("uncovered_segments", 0) == len([s for s, z in more if s and z not in (1, 2, 3)])


def test_rules_count_rows_as_often_as_they_stand_for_segments(rows):
    v = [("0", 3, w, t, -1.0 if i == 7 else 1.0, 5) for i, (w, t) in enumerate(WEEK)] + [("1", 3, w, t, 1.0, 2) for w, t in WEEK]
    v += [("1", 3, "MON", "0000", 1.0, 2)] * 2 + [("0", 4, "TUE", "0015", None, 5)] * 2
    got = {r.rule: r.n for r in demand.segment_violations(rows("segment_id string, type int, dow string, time string, value double, times long", *v), rows("segment_id string, zone_id int", *[(s, 1) for s in "abcdefg"])).collect()}
    assert got == {"negative_values": 5, "null_values": 10, "wrong_type": 10, "unknown_slots": 10, "duplicate_keys": 2 + 5, "row_count_off": 2 * 2 + 5 * 2}
