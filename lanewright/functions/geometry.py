"""Plane geometry as array expressions: a path is array<struct<x double, y double>>, a polygon an array of closed rings.

Every function binds its array arguments once (``bound``), so that lambdas refer to values and not to the text
they were parsed from.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"


def bound(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def point(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _pairs(text: Column) -> Column:
    number = r"(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"
    found = F.regexp_extract_all(text, F.lit(rf"{number}\s+{number}"), F.lit(0))
    return F.transform(found, lambda p: point(F.split_part(p, F.lit(" "), F.lit(1)), F.split_part(p, F.lit(" "), F.lit(2))))


def wkt_parts(wkt: Column) -> Column:
    """Lines or rings of LINESTRING, MULTILINESTRING, POLYGON or MULTIPOLYGON text, each an array of points."""
    groups = F.regexp_extract_all(F.regexp_replace(wkt, r"\s+", " "), F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(groups, _pairs)


def wkt_points(wkt: Column) -> Column:
    """All points in order, parts chained."""
    return F.flatten(wkt_parts(wkt))


def link_points(text: Column) -> Column:
    """"lat,lon lat,lon" to points (lon, lat); bad pairs are skipped; fewer than two points give null."""
    pairs = F.transform(F.split(F.trim(text), r"\s+"), lambda p: F.struct(
        F.get(F.split(p, ","), F.lit(1)).try_cast("double").alias("x"), F.get(F.split(p, ","), F.lit(0)).try_cast("double").alias("y")
    ))
    good = F.filter(pairs, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    return bound(good, lambda g: F.when(F.size(g) >= 2, g))


def to_link_points(points: Column) -> Column:
    return F.array_join(F.transform(points, lambda p: F.format_string("%.7f,%.7f", p["y"], p["x"])), " ")


# The plane coordinate system of the New York Long Island zone (Lambert conformal conic, GRS80, US feet).
GRS80_A, GRS80_F = 6378137.0, 1 / 298.257222101
PARALLEL_1, PARALLEL_2 = math.radians(41 + 2 / 60), math.radians(40 + 40 / 60)
ORIGIN_LAT, ORIGIN_LON = math.radians(40 + 10 / 60), math.radians(-74)
FALSE_EAST, US_FOOT = 300000.0, 1200 / 3937


def _cone() -> tuple[float, float, float, float]:
    e = math.sqrt(2 * GRS80_F - GRS80_F**2)
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    n = (math.log(m(PARALLEL_1)) - math.log(m(PARALLEL_2))) / (math.log(t(PARALLEL_1)) - math.log(t(PARALLEL_2)))
    f = m(PARALLEL_1) / (n * t(PARALLEL_1) ** n)
    return e, n, GRS80_A * f, GRS80_A * f * t(ORIGIN_LAT) ** n


def to_feet(lon: Column, lat: Column) -> Column:
    """Degrees to plane feet."""
    e, n, af, rho0 = _cone()
    p = F.radians(lat)
    es = F.lit(e) * F.sin(p)
    t = F.tan(F.lit(math.pi / 4) - p / 2) / F.pow((1 - es) / (1 + es), F.lit(e / 2))
    rho, theta = F.lit(af) * F.pow(t, F.lit(n)), F.lit(n) * (F.radians(lon) - ORIGIN_LON)
    return point((F.lit(FALSE_EAST) + rho * F.sin(theta)) / US_FOOT, (F.lit(rho0) - rho * F.cos(theta)) / US_FOOT)


def to_degrees(x: Column, y: Column, rounds: int = 5) -> Column:
    """Plane feet to (lon, lat) degrees; the latitude's fixed point is reached within a few rounds."""
    e, n, af, rho0 = _cone()
    de, dn = x * US_FOOT - FALSE_EAST, F.lit(rho0) - y * US_FOOT
    t = F.pow(F.sqrt(de * de + dn * dn) / af, F.lit(1 / n))

    def closer(p: Column, _: Column) -> Column:
        es = F.lit(e) * F.sin(p)
        return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - es) / (1 + es), F.lit(e / 2)))

    lat = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.lit(math.pi / 2) - 2 * F.atan(t), closer)
    return point(F.degrees(F.atan2(de, dn) / n + ORIGIN_LON), F.degrees(lat))


def edges(points: Column) -> Column:
    """Segments between neighbouring points: array<struct<ax, ay, bx, by>>."""
    return bound(points, lambda p: F.zip_with(
        F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))),
        lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
    ))


def part_edges(parts: Column) -> Column:
    """Edges of all parts or rings; no edge joins one part to the next."""
    return F.flatten(F.transform(parts, edges))


def edge_point_distance(e: Column, x: Column, y: Column) -> Column:
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    along = F.coalesce(F.try_divide((x - e["ax"]) * dx + (y - e["ay"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    return F.hypot(x - e["ax"] - t * dx, y - e["ay"] - t * dy)


def edges_point_distance(es: Column, x: Column, y: Column) -> Column:
    return F.array_min(F.transform(es, lambda e: edge_point_distance(e, x, y)))


def inside(es: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over a polygon's edges; a point on the border is inside."""

    def crosses(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        return F.when(spans, x < e["ax"] + (y - e["ay"]) * F.try_divide(e["bx"] - e["ax"], e["by"] - e["ay"])).otherwise(False)

    odd = F.size(F.filter(es, crosses)) % 2 == 1
    return odd | F.exists(es, lambda e: edge_point_distance(e, x, y) == 0)


def polygon_distance(es: Column, x: Column, y: Column) -> Column:
    return F.when(inside(es, x, y), 0.0).otherwise(edges_point_distance(es, x, y))


def _turn(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def edges_touch(a: Column, b: Column) -> Column:
    """Do two segments cross or touch?"""
    d1 = _turn(a["ax"], a["ay"], a["bx"], a["by"], b["ax"], b["ay"])
    d2 = _turn(a["ax"], a["ay"], a["bx"], a["by"], b["bx"], b["by"])
    d3 = _turn(b["ax"], b["ay"], b["bx"], b["by"], a["ax"], a["ay"])
    d4 = _turn(b["ax"], b["ay"], b["bx"], b["by"], a["bx"], a["by"])
    cross = (((d1 > 0) & (d2 < 0)) | ((d1 < 0) & (d2 > 0))) & (((d3 > 0) & (d4 < 0)) | ((d3 < 0) & (d4 > 0)))
    return cross | (edge_distance_ends(a, b) == 0)


def edge_distance_ends(a: Column, b: Column) -> Column:
    return F.least(
        edge_point_distance(a, b["ax"], b["ay"]), edge_point_distance(a, b["bx"], b["by"]),
        edge_point_distance(b, a["ax"], a["ay"]), edge_point_distance(b, a["bx"], a["by"]),
    )


def lines_distance(es: Column, fs: Column) -> Column:
    """0 where two paths cross, else the least distance from an end of one's edge to an edge of the other."""
    return F.array_min(F.transform(es, lambda a: F.array_min(F.transform(fs, lambda b: F.when(edges_touch(a, b), 0.0).otherwise(edge_distance_ends(a, b))))))


def line_meets_polygon(line: Column, es: Column) -> Column:
    """Any vertex inside, or any edge that touches the border."""
    vertex = F.exists(line, lambda p: inside(es, p["x"], p["y"]))
    return vertex | F.exists(edges(line), lambda a: F.exists(es, lambda b: edges_touch(a, b)))


def midpoint(points: Column) -> Column:
    """Point at half the length of a path."""

    def on(p: Column) -> Column:
        es = edges(p)

        def walk(e_list: Column) -> Column:
            length = lambda e: F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"])
            total = F.aggregate(e_list, F.lit(0.0), lambda acc, e: acc + length(e))
            start = F.struct(total.alias("left"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
            start = F.struct((start["left"] / 2).alias("left"), start["x"].alias("x"), start["y"].alias("y"))

            def step(acc: Column, e: Column) -> Column:
                share = F.coalesce(F.try_divide(acc["left"], length(e)), F.lit(0.0))
                here = acc["x"].isNull() & (acc["left"] <= length(e))
                return F.struct(
                    F.when(acc["x"].isNull() & ~here, acc["left"] - length(e)).otherwise(acc["left"]).alias("left"),
                    F.when(here, e["ax"] + share * (e["bx"] - e["ax"])).otherwise(acc["x"]).alias("x"),
                    F.when(here, e["ay"] + share * (e["by"] - e["ay"])).otherwise(acc["y"]).alias("y"),
                )

            end = F.aggregate(e_list, start, step)
            last = F.element_at(p, -1)
            return F.when(F.size(e_list) > 0, point(F.coalesce(end["x"], last["x"]), F.coalesce(end["y"], last["y"]))).otherwise(F.get(p, F.lit(0)))

        return bound(es, walk)

    return bound(points, on)


def bounds(points: Column) -> Column:
    """struct<x0, y0, x1, y1> of a path's box."""
    return bound(points, lambda p: F.struct(
        F.array_min(F.transform(p, lambda q: q["x"])).alias("x0"), F.array_min(F.transform(p, lambda q: q["y"])).alias("y0"),
        F.array_max(F.transform(p, lambda q: q["x"])).alias("x1"), F.array_max(F.transform(p, lambda q: q["y"])).alias("y1"),
    ))


def edge_cells(es: Column, pad: float, size: Column | float) -> Column:
    """Grid cells (struct<cx, cy>) within ``pad`` of a path's edges, column by column: linear in the path's length."""
    column = lambda x: F.floor(x / size)

    def of(e: Column) -> Column:
        left, right = F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])

        def height(x: Column) -> Column:
            t = F.coalesce(F.try_divide(x - e["ax"], e["bx"] - e["ax"]), F.lit(0.0))
            return e["ay"] + t * (e["by"] - e["ay"])

        def down(cx: Column) -> Column:
            upright = e["ax"] == e["bx"]
            a = F.when(upright, e["ay"]).otherwise(height(F.greatest(left, cx * size - pad)))
            b = F.when(upright, e["by"]).otherwise(height(F.least(right, (cx + 1) * size + pad)))
            rows = F.sequence(column(F.least(a, b) - pad), column(F.greatest(a, b) + pad))
            return F.transform(rows, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

        return F.flatten(F.transform(F.sequence(column(left - pad), column(right + pad)), down))

    return F.array_distinct(F.flatten(F.transform(es, of)))


def cells(box: Column, pad: Column | float, size: Column | float) -> Column:
    """Grid cells (struct<cx, cy>) that a padded box touches."""

    def span(lo: Column, hi: Column) -> Column:
        return F.sequence(F.floor((lo - pad) / size), F.floor((hi + pad) / size))

    return bound(box, lambda b: F.flatten(F.transform(span(b["x0"], b["x1"]), lambda cx: F.transform(span(b["y0"], b["y1"]), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))))))


#: Cells of this level are the smallest that shapes are put in: 2**-10 of a unit.
FINEST = -10


def level_of(extent: Column) -> Column:
    """The level whose cells, 2**level wide, are about as wide as ``extent``, so that a box of it touches few of them."""
    return F.greatest(F.lit(FINEST), F.ceil(F.log2(F.greatest(extent, F.lit(2.0**FINEST))))).cast("int")


def level_cells(box: Column, pad: float, level: Column) -> Column:
    """Cells (struct<level, cx, cy>) of one level that a padded box touches."""
    return F.transform(cells(box, pad, F.pow(F.lit(2.0), level)), lambda c: F.named_struct(F.lit("level"), level, F.lit("cx"), c["cx"], F.lit("cy"), c["cy"]))


def inner_cells(es: Column, box: Column, size: Column) -> Column:
    """Cells (struct<cx, cy>) that lie inside a polygon as a whole: their centre is inside and no edge enters them."""
    free = F.array_except(cells(box, 0.0, size), edge_cells(es, 0.0, size))
    return F.filter(free, lambda c: inside(es, (c["cx"] + 0.5) * size, (c["cy"] + 0.5) * size))


def finite(*values: Column) -> Column:
    """True where all are numbers, neither null nor NaN nor infinite."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)) for v in values])
