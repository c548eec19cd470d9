from lanewright.operators import demand, routes


def test_only_asked_slots_meet_the_requests(rows, spark):
    """The weekdays and slots that are asked for are picked before the zone values are expanded to segments."""
    zoned = rows("zone_id int, type int, dow string, time string, value double", *[(1, 3, w, t, float(i)) for i, w in enumerate(demand.ts.WEEKDAYS) for t in demand.ts.SLOTS])
    mapping = rows("segment_id string, zone_id int", ("a", 1), ("b", 1))
    asked = [(1, 1, "a", 3, "2024-01-15", "08:10"), (1, 2, "b", 3, "2024-01-16", "23:59"), (2, 1, "zz", 3, "2024-01-15", "08:00"), (3, 1, "a", 3, "no date", "08:00"), (3, 2, "a", 3, None, None)]
    out = routes.score_demand(rows("route_id long, pos long, segment_id string, type int, date string, time string", *asked), demand.expand_to_segments(zoned, mapping), mapping, zoned.limit(0))
    assert {(r.route_id, r.pos): (r.value, r.token) for r in out.collect()} == {
        (1, 1): (0.0, "rds:modeled_aggregate"), (1, 2): (1.0, "rds:modeled_aggregate"), (2, 1): (0.0, routes.STATIC), (3, 1): (0.0, routes.STATIC), (3, 2): (0.0, routes.STATIC),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
