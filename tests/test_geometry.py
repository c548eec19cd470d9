import random
import pytest
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.operators import spatial


def squares(rows, *xs):
    """Unit squares at (x, 0)."""
    return rows("zone_id int, wkt string", *[(z, f"POLYGON (({x} 0, {x + 1} 0, {x + 1} 1, {x} 1, {x} 0))") for z, x in xs]).select("zone_id", F.lit("q").alias("borough"), geo.wkt_parts(F.col("wkt")).alias("parts"))


def test_projection_both_ways(rows):
    r = rows("lon double, lat double", (-73.98, 40.75)).select(geo.to_feet(F.col("lon"), F.col("lat")).alias("f")).first().f
    assert (r.x, r.y) == (pytest.approx(989791.457, abs=0.01), pytest.approx(212522.519, abs=0.01))
    b = rows("x double, y double", (r.x, r.y)).select(geo.to_degrees(F.col("x"), F.col("y")).alias("g")).first().g
    assert (b.x, b.y) == (pytest.approx(-73.98, abs=1e-9), pytest.approx(40.75, abs=1e-9))


def test_zone_of_a_point(rows):
    p = rows("segment_id string, x double, y double", ("in", 0.5, 0.5), ("border", 1.0, 0.5), ("gap", 1.2, 0.5), ("far", 90.0, 0.5))
    out = {r.segment_id: (r.zone_id, r.mapping_method, round(r.distance_ft, 6)) for r in spatial.points_to_zones(p, squares(rows, (2, 0), (1, 2)), cell=0.5).collect()}
    assert out == {"in": (2, "contains", 0), "border": (2, "contains", 0), "gap": (2, "nearest", 0.2), "far": (1, "nearest", 87.0)}


def test_shared_border_takes_the_lowest_zone(rows):
    p = rows("segment_id string, x double, y double", ("b", 1.0, 0.5))
    assert spatial.points_to_zones(p, squares(rows, (9, 0), (4, 1)), cell=1.0).first().zone_id == 4


def line(rows, name, *pts):
    return rows(f"{name} string, wkt string", *pts).select(name, geo.wkt_points(F.col("wkt")).alias("points"))


def test_links_near_nearest_and_dropped(rows):
    links = line(rows, "link_id", ("near", "LINESTRING (0 0, 100 0)"), ("fall", "LINESTRING (0 600, 100 600)"), ("gone", "LINESTRING (0 9000, 100 9000)"))
    seg = line(rows, "segment_id", ("a", "LINESTRING (0 30, 100 30)"), ("b", "LINESTRING (50 -10, 50 10)"), ("c", "LINESTRING (0 100, 100 100)"))
    out = {(r.link_id, r.segment_id): (r.distance_ft, r.mapping_method, r.far_match) for r in spatial.links_to_segments(links, seg).collect()}
    assert out == {("near", "a"): (30, "buffer", False), ("near", "b"): (0, "buffer", False), ("fall", "c"): (500, "nearest_fallback", True)}


def test_fence(rows):
    s = line(rows, "segment_id", ("in", "LINESTRING (0.2 0.2, 0.4 0.4)"), ("cross", "LINESTRING (-1 0.5, 2 0.5)"), ("touch", "LINESTRING (1 1, 2 2)"), ("out", "LINESTRING (3 3, 4 4)"))
    out = {r.segment_id for r in spatial.segments_in_fence(s, squares(rows, (1, 0))).collect()}
    assert out == {"in", "cross", "touch"}


def test_parts_make_no_false_edge(rows):
    r = rows("w string", ("MULTILINESTRING ((0 0, 1 0), (5 5, 6 5))",)).select(F.size(geo.part_edges(geo.wkt_parts(F.col("w")))).alias("n"), F.size(geo.wkt_points(F.col("w"))).alias("p")).first()
    assert (r.n, r.p) == (2, 4)


def test_midpoint_and_link_points(rows):
    r = rows("w string, l string", ("LINESTRING (0 0, 2 0, 2 4)", "40.7,-73.9 x,y 40.8,-73.8"), ("LINESTRING (1 1, 1 1)", "40.7,-73.9")).select(geo.midpoint(geo.wkt_points(F.col("w"))).alias("m"), geo.link_points(F.col("l")).alias("l"), geo.to_link_points(geo.link_points(F.col("l"))).alias("t")).collect()
    assert (r[0].m.x, r[0].m.y) == (2, 1) and (r[1].m.x, r[1].m.y) == (1, 1)
    assert len(r[0].l) == 2 and r[1].l is None
    assert r[0].t == "40.7000000,-73.9000000 40.8000000,-73.8000000"


def test_points_without_finite_coordinates_leave_the_others_alone(rows):
    """NaN, infinite and null coordinates get no zone; the others keep their nearest one."""
    nan, inf = float("nan"), float("inf")
    p = rows("segment_id string, x double, y double", ("a", 5.5, 0.5), ("b", 9.0, 9.0), ("c", 0.5, 0.5), ("n", nan, 1.0), ("i", inf, 0.0), ("j", 0.0, -inf), ("z", None, 1.0))
    got = {r.segment_id: (r.zone_id, r.mapping_method) for r in spatial.points_to_zones(p, squares(rows, (0, 0), (1, 5)), cell=0.25).collect()}
    assert set(got) == {"a", "b", "c"} and got["c"][1] == "contains" and got["b"][1] == "nearest"


def test_weights_with_a_point_that_is_nowhere(rows):
    cells = rows("zone_id int, x double, y double, n long", (1, 0.0, 50.0, 5), (1, float("nan"), 0.0, 9), (1, float("inf"), 0.0, 9), (1, None, 0.0, 9))
    segs = rows("zone_id int, segment_id string, w string", (1, "a", "LINESTRING (0 0, 1 0)"), (1, "b", "LINESTRING (0 900, 1 900)")).select("zone_id", "segment_id", geo.wkt_points(F.col("w")).alias("points"))
    for reach in (10.0, 100.0):  # beyond reach and within it
        got = {r.segment_id: r.weight for r in spatial.share_weights(cells, segs, reach=reach).collect()}
        assert got == {"a": pytest.approx(6 / 7), "b": pytest.approx(1 / 7)}


def test_zones_of_unlike_sizes_need_few_cells(spark):
    """A zone has four cells at most at the level of its size, a millionth of a unit wide or a million."""
    size = 10.0 ** (F.col("id") % 13 - 6)
    z = spark.range(400).select(size.alias("s"), (F.rand(1) * 1e5 - 5e4).alias("x"), (F.rand(2) * 1e5 - 5e4).alias("y"))
    box = F.struct(F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("s")).alias("x1"), (F.col("y") + F.col("s") / 3).alias("y1"))
    n = z.select(box.alias("box"), geo.level_of(F.col("s")).alias("level")).select(F.size(geo.level_cells(F.col("box"), 0.0, F.col("level"))).alias("n")).agg(F.max("n")).first()[0]
    assert n <= 6


def plain_fence(lines, polygons):
    def inside(x, y, ring):
        on = any(min((x - ax) * (bx - ax) + (y - ay) * (by - ay), 1) is not None and abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) < 1e-12 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by) for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False))
        odd = sum((ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False)) % 2
        return on or odd

    def cross(p, q, r, s):
        t = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return t(p, q, r) * t(p, q, s) <= 0 and t(r, s, p) * t(r, s, q) <= 0

    return {i for i, line in lines.items() for ring in polygons if any(inside(*v, ring) for v in line) or any(cross(a, b, c, d) for a, b in zip(line, line[1:], strict=False) for c, d in zip(ring, ring[1:], strict=False))}


def test_a_fence_of_many_polygons(spark, rows):
    """Equal to comparing all pairs; polygons from a hundredth to hundreds of units wide, and no nested loop in the plan."""
    rng = random.Random(3)
    polygons = []
    for k in range(60):
        x, y, s = rng.uniform(0, 1000), rng.uniform(0, 1000), 10 ** rng.uniform(-2, 2.4 if k < 3 else 1.3)
        ring = [(x, y), (x + s, y + s / 7), (x + s * 0.9, y + s), (x + s / 2, y + s / 2), (x, y + s)]
        polygons.append([*ring, ring[0]])
    lines = {f"s{k}": [(rng.uniform(0, 1000), rng.uniform(0, 1000))] for k in range(40)}
    for k in range(300):
        x, y = rng.uniform(0, 1000), rng.uniform(0, 1000)
        lines[f"l{k}"] = [(x, y)] + [(x + rng.gauss(0, 25), y + rng.gauss(0, 25)) for _ in range(rng.randrange(1, 4))]
    wkt = lambda pts: ", ".join(f"{a!r} {b!r}" for a, b in pts)
    s = rows("segment_id string, points array<struct<x:double,y:double>>", *lines.items(), ("none", None), ("empty", []), ("nan", [(float("nan"), 1.0), (500.0, 500.0)]))
    f = rows("w string", *[(f"POLYGON (({wkt(p)}))",) for p in polygons]).select(geo.wkt_parts(F.col("w")).alias("parts"))
    out = spatial.segments_in_fence(s, f)
    assert {r.segment_id for r in out.collect()} == plain_fence(lines, polygons)
    many = spark.range(10_000).select(F.array(F.transform(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 0))]), lambda c: geo.point(F.col("id") * 3.0 + c["a"], F.col("id") * 3.0 + c["b"]))).alias("parts"))
    out = spatial.segments_in_fence(s, many)
    assert out.count() < 60 and "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_hops_follow_no_walk_twice(rows):
    """A ring, a loop and a branch; the ring's far side is reached once, from the nearer way."""
    e = rows("a int, b int", *[(i, (i + 1) % 6) for i in range(6)], (0, 0), (2, 9), (2, 1))
    got = {(r.segment_id, r.other): r.hop for r in spatial.within_hops(e, rows("segment_id int", (0,), (0,), (77,)), hops=9).collect()}
    assert got == {(0, 1): 1, (0, 5): 1, (0, 2): 2, (0, 4): 2, (0, 3): 3, (0, 9): 3}
