"""Spatial joins without a geometry library: candidates by grid cell, exact predicates as array expressions.

Nearest fallbacks widen their rings of cells for what is still unmatched, so no pass compares everything with everything.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.operators import nearby
from lanewright.operators.quality import running_counts
from lanewright.operators.trips import SUSPECT
from lanewright.scratch import materialise

NEAR_FEET, WARN_FEET, FAR_FEET = 50.0, 200.0, 1000.0


def _levels(shapes: DataFrame) -> list[int]:
    """The levels in use; there are a few dozen at most."""
    return sorted(r[0] for r in shapes.select("level").distinct().collect())


def points_to_zones(points: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """(segment_id, x, y) and (zone_id, borough, parts) to (segment_id, zone_id, borough, mapping_method, distance_ft).

    The containing zone (least id of several, borders count); else the nearest, least id on ties. A zone lies in the cells of
    the level of its own size, four at most, and a point looks up one cell of each level in use, so a wide zone and a small one
    are met in the same pass. For the points that are left the reach grows fourfold from ``cell``, pass by pass, until a zone
    lies within it; zones smaller than the reach are put into cells of its size, so a point looks up nine cells of a level at
    most. Points without finite coordinates get no row, zones without finite borders no points.
    """
    z = zones.select("zone_id", "borough", geo.part_edges(F.col("parts")).alias("es"), geo.bounds(F.flatten("parts")).alias("box"))
    z = z.filter(geo.finite(*[F.col(f"box.{c}") for c in ("x0", "y0", "x1", "y1")]))
    z = materialise(z.withColumn("level", geo.level_of(F.greatest(F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0")))), "zones")
    levels = _levels(z)
    p = points.select("segment_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter(geo.finite(F.col("x"), F.col("y")))
    at = F.struct(F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))

    def met(points: DataFrame, reach: float) -> DataFrame:
        least = max(geo.FINEST, math.ceil(math.log2(reach))) if reach else geo.FINEST
        of = lambda box, pad, level: F.explode(geo.level_cells(box, pad, level)).alias("c")
        near = z.select("zone_id", "borough", "es", of(F.col("box"), 0.0, F.greatest("level", F.lit(least))))
        each = points.withColumn("level", F.explode(F.array(*[F.lit(k) for k in sorted({max(k, least) for k in levels})])))
        return each.select("segment_id", "x", "y", of(at, reach, F.col("level"))).join(near, "c")

    hit = met(p, 0.0).filter(geo.inside(F.col("es"), F.col("x"), F.col("y"))) if levels else None
    if hit is None:
        return p.select("segment_id", F.lit(None).cast(dict(zones.dtypes)["zone_id"]).alias("zone_id"), F.lit(None).cast("string").alias("borough"), F.lit("").alias("mapping_method"), F.lit(0.0).alias("distance_ft")).limit(0)
    found = hit.groupBy("segment_id").agg(F.min(F.struct("zone_id", "borough")).alias("z"))
    out = found.select("segment_id", "z.zone_id", "z.borough", F.lit("contains").alias("mapping_method"), F.lit(0.0).alias("distance_ft"))
    out = materialise(out, "zone-hits")
    left = materialise(p.join(out, "segment_id", "left_anti"), "zone-left")
    widest, reach = _extent(left.select(at.alias("box")).unionByName(z.select("box"))), cell
    while not left.isEmpty() and reach <= 8 * widest:
        d = geo.polygon_distance(F.col("es"), F.col("x"), F.col("y"))
        best = met(left, reach).select("segment_id", F.struct(d.alias("d"), "zone_id", "borough").alias("m")).groupBy("segment_id").agg(F.min("m").alias("m"))
        best = best.filter(F.col("m.d") <= reach)  # beyond that a zone outside the cells may be nearer
        got = materialise(best.select("segment_id", "m.zone_id", "m.borough", F.lit("nearest").alias("mapping_method"), F.col("m.d").alias("distance_ft")), "zone-near")
        out, left, reach = out.unionByName(got), materialise(left.join(got, "segment_id", "left_anti"), "zone-left"), reach * 4
    return out


def _extent(boxes: DataFrame) -> float:
    """Upper bound of the distance between any two things in ``box``."""
    e = boxes.agg(F.max("box.x1").alias("x1"), F.min("box.x0").alias("x0"), F.max("box.y1").alias("y1"), F.min("box.y0").alias("y0")).first()
    return 0.0 if e.x1 is None else (e.x1 - e.x0) + (e.y1 - e.y0)


def segments_to_zones(segments: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """Segments (segment_id, geometry as WKT) by the midpoint of their line."""
    mid = segments.select("segment_id", geo.midpoint(geo.wkt_points(F.col("geometry"))).alias("m")).select("segment_id", "m.x", "m.y")
    return points_to_zones(mid, zones, cell)


def flag_mapping(mapping: DataFrame) -> DataFrame:
    return mapping.withColumn(SUSPECT, F.col("mapping_method") == "nearest")


METHODS = ["contains", "nearest"]


def mapping_violations(mapping: DataFrame, segments: DataFrame, zone_range: tuple[int, int], suspect_limit: float) -> DataFrame:
    """Rows (rule, n) with n > 0 for each broken rule of a flagged mapping: one row for each segment and for no other id, zones
    within their range, known methods, and the share of suspects, which count only beyond the limit."""
    one = mapping.agg(
        F.count_if(F.col("segment_id").isNull()).alias("null_segments"), F.count_if(F.col("zone_id").isNull()).alias("null_zones"),
        F.count_if(~F.col("zone_id").between(*zone_range)).alias("zones_out_of_range"), F.count_if(~F.coalesce(F.col("mapping_method").isin(METHODS), F.lit(False))).alias("unknown_methods"),
        F.count_if(F.col(SUSPECT)).alias("flagged"), F.count("*").alias("rows"),
    )
    # each id with its rows on either side: repeats and both differences come from one grouping
    want = segments.select(F.col("segment_id").cast("string").alias("id")).distinct().withColumns({"want": F.lit(1), "got": F.lit(0)})
    have = mapping.filter("segment_id IS NOT NULL").select(F.col("segment_id").cast("string").alias("id"), F.lit(0).alias("want"), F.lit(1).alias("got"))
    ids = want.unionByName(have).groupBy("id").agg(F.sum("want").alias("want"), F.sum("got").alias("got"))
    ids = ids.agg(F.count_if(F.col("got") > 1).alias("repeated_segments"), F.count_if(F.col("got") == 0).alias("missing_segments"), F.count_if(F.col("want") == 0).alias("extra_segments"))
    all_ = one.crossJoin(ids).withColumn("suspects", F.when(F.col("flagged") > F.col("rows") * suspect_limit, F.col("flagged")).otherwise(0))
    rules = ["null_segments", "repeated_segments", "missing_segments", "extra_segments", "null_zones", "zones_out_of_range", "unknown_methods", "suspects"]
    return all_.select(*[F.col(r).cast("long").alias(r) for r in rules]).unpivot([], rules, "rule", "n").filter("n > 0")


def zone_violations(zones: DataFrame, polygons: tuple[int, int]) -> DataFrame:
    """Rows (rule, n) with n > 0: the number of zones outside its range, zones without an id, without a border, with an open ring."""
    closed = F.forall("parts", lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.element_at(r, -1)))
    bare = F.col("parts").isNull() | (F.size("parts") == 0)
    one = zones.agg(F.count_if(F.col("zone_id").isNull()).alias("null_ids"), F.count_if(bare).alias("without_border"), F.count_if(~bare & ~F.coalesce(closed, F.lit(False))).alias("open_rings"), F.count("*").alias("rows"))
    off = F.greatest(F.lit(polygons[0]) - F.col("rows"), F.col("rows") - F.lit(polygons[1]), F.lit(0))
    rules = ["null_ids", "without_border", "open_rings", "count_off"]
    return one.withColumn("count_off", off).select(*[F.col(r).cast("long").alias(r) for r in rules]).unpivot([], rules, "rule", "n").filter("n > 0")


def links_to_segments(links: DataFrame, segments: DataFrame, near: float = NEAR_FEET, far: float = FAR_FEET, warn: float = WARN_FEET) -> DataFrame:
    """(link_id, points) and (segment_id, points) to (link_id, segment_id, distance_ft, mapping_method, far_match).

    All segments within ``near``; a link without any takes the nearest one up to ``far`` and otherwise none.
    """
    shapes = segments.select("segment_id", geo.edges(F.col("points")).alias("es"))
    b = materialise(nearby.shapes_of(shapes, [], "segment_id", F.col("es")), "segments")
    a = materialise(nearby.shapes_of(links.select("link_id", geo.edges(F.col("points")).alias("es")), [], "link_id", F.col("es")), "links")
    edge = F.col("e")
    usual = b.select(F.explode("es").alias("e")).agg(F.avg(F.greatest(F.abs(edge["bx"] - edge["ax"]), F.abs(edge["by"] - edge["ay"])))).first()[0] or 0.0
    size = lambda reach: max(reach * 2, usual, 1e-9)
    left, right = nearby.blocks(a, [], size(near)), nearby.blocks(b, [], size(near))
    # the links that have some are found first and the pairs made as they are read: they may be more than fit a shuffle
    some = materialise(nearby.nearest(left, right, near).select("id"), "links-near")
    pairs, rest = nearby.within(left, right, near).withColumn("mapping_method", F.lit("buffer")), materialise(a.join(some, "id", "left_anti"), "links-rest")
    if not rest.isEmpty():
        fallback = nearby.nearest(nearby.blocks(rest, [], size(far)), nearby.blocks(b, [], size(far)), far)
        pairs = pairs.unionByName(fallback.select("id", "m.other", "m.d", F.lit("nearest_fallback").alias("mapping_method")))
    return pairs.select(F.col("id").alias("link_id"), F.col("other").alias("segment_id"), F.col("d").alias("distance_ft"), "mapping_method", (F.col("d") > warn).alias("far_match"))


def segments_in_fence(segments: DataFrame, fence: DataFrame) -> DataFrame:
    """Ids of segments (segment_id, points) that touch or enter a polygon of ``fence`` (parts: rings of points).

    A polygon lies in the cells of the level of its size, and its area is cut eight times finer: cells that are inside as a
    whole take a segment by one of its vertices, without an exact test. All other segments meet the polygons whose cells their
    edges enter, where an edge is cut into sixteen, and are tested exactly. Both are equi joins on cells. A segment or polygon without finite points meets nothing.
    """
    sides = ("x0", "y0", "x1", "y1")
    f = fence.select(F.monotonically_increasing_id().alias("fid"), geo.part_edges(F.col("parts")).alias("es"), geo.bounds(F.flatten("parts")).alias("box"))
    f = f.filter(geo.finite(*[F.col(f"box.{c}") for c in sides]))
    f = materialise(f.withColumn("level", geo.level_of(F.greatest(F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0")))), "fence")
    s = segments.select(F.monotonically_increasing_id().alias("sid"), "segment_id", "points", geo.bounds(F.col("points")).alias("sbox"))
    s = materialise(s.filter(geo.finite(*[F.col(f"sbox.{c}") for c in sides])).drop("sbox"), "fence-segments")
    levels = _levels(f)
    if not levels:
        return s.select("segment_id").limit(0)
    every = F.explode(F.array(*[F.lit(k) for k in levels])).alias("level")
    size = F.pow(F.lit(2.0), F.col("level"))
    inner = f.select("level", F.explode(geo.inner_cells(F.col("es"), F.col("box"), size / 8)).alias("c")).distinct()
    vertices = s.select("sid", "segment_id", F.explode("points").alias("v")).select("sid", "segment_id", "v", every)
    cell = F.struct(F.floor(F.col("v.x") / (size / 8)).alias("cx"), F.floor(F.col("v.y") / (size / 8)).alias("cy"))
    sure = materialise(vertices.withColumn("c", cell).join(inner, ["level", "c"], "left_semi").select("sid", "segment_id").distinct(), "fence-inside")
    rest = s.join(sure, "sid", "left_anti")
    # a segment of one point is an edge without length
    path = geo.edges(F.when(F.size("points") > 1, F.col("points")).otherwise(F.concat("points", "points")))
    e = rest.select("sid", path.alias("path")).select("sid", F.explode("path").alias("e"))
    own = geo.level_of(F.greatest(F.abs(F.col("e.bx") - F.col("e.ax")), F.abs(F.col("e.by") - F.col("e.ay")))) - 4
    e = materialise(e.withColumn("level", F.greatest(own, F.lit(geo.FINEST))), "fence-edges")
    # an edge and a polygon meet at the level of the coarser of the two, where both have some dozen cells at most
    meets = lambda others: F.explode(F.array_distinct(F.transform(F.array(*[F.lit(k) for k in others]), lambda k: F.greatest(k, F.col("level"))))).alias("at")
    width = F.pow(F.lit(2.0), F.col("at"))
    lines = e.select("sid", "e", meets(levels)).select("sid", "at", F.explode(geo.edge_cells(F.array("e"), 0.0, width)).alias("c"))
    areas = f.select("fid", "box", meets(_levels(e) or [0])).select("fid", "at", F.explode(geo.cells(F.col("box"), 0.0, width)).alias("c"))
    pairs = lines.join(areas, ["at", "c"]).select("sid", "fid").distinct()
    tested = pairs.join(rest.select("sid", "segment_id", "points"), "sid").join(f.select("fid", "es"), "fid").filter(geo.line_meets_polygon(F.col("points"), F.col("es")))
    return sure.select("segment_id").unionByName(tested.select("segment_id")).distinct()


def share_weights(cells: DataFrame, segments: DataFrame, reach: float = 100.0, alpha: float = 1.0) -> DataFrame:
    """A zone's counted grid points (zone_id, x, y, n) shared out to its segments (zone_id, segment_id, points).

    A point's count goes to the segments within reach by 1 / (distance + 1); without any, all of it to the nearest of the
    zone (least id on ties). Each segment has alpha added; weights of a zone add up to 1. Points without finite coordinates
    count for none; neither they nor a segment without finite points changes what the others get.
    """
    s = segments.select("zone_id", "segment_id", geo.edges(F.col("points")).alias("es"), geo.bounds(F.col("points")).alias("box"))
    whole_box = geo.finite(*[F.col(f"box.{c}") for c in ("x0", "y0", "x1", "y1")])
    s, zone = materialise(s, "weight-segments"), ["zone_id"]
    fine = s.filter(whole_box)
    lines = materialise(nearby.shapes_of(fine, zone, "segment_id", F.col("es")), "weight-lines")
    usual = fine.agg(F.avg(F.greatest(F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0")))).first()[0] or 0.0
    size = lambda reach: max(reach * 2, usual, 1e-9)
    c = cells.groupBy("zone_id", "x", "y").agg(F.sum("n").alias("n")).filter(geo.finite(F.col("x"), F.col("y")))
    c = c.select("zone_id", F.monotonically_increasing_id().alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("n").cast("double").alias("n"))
    spot = F.array(F.struct(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("x").alias("bx"), F.col("y").alias("by")))
    c = materialise(c, "weight-points").withColumn("es", spot)
    items, b = ["zone_id", "id", "es"], nearby.blocks(lines, zone, size(reach))
    # a point's pulls are added up first, then each pair is measured again for its share: no pair is written or shuffled
    pull = materialise(nearby.nearest(nearby.blocks(c.select(*items), zone, size(reach)), b, reach, zone, points=True).select("id", "pull"), "weight-near")
    v = nearby.blocks(c.join(pull, "id").select(*items, (F.col("n") / F.col("pull")).alias("v")), zone, size(reach))
    shares = [nearby.pulled(v, b, reach, zone, points=True).select("zone_id", F.col("other").alias("segment_id"), "share")]
    left, reach = materialise(c.join(pull, "id", "left_anti"), "weight-left"), reach * 4
    at = F.struct(F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    widest = _extent(left.select(at.alias("box")).unionByName(fine.select("box")))
    while not left.isEmpty() and reach <= 8 * widest:
        met = nearby.nearest(nearby.blocks(left.select(*items), zone, size(reach)), nearby.blocks(lines, zone, size(reach)), reach, zone, points=True)
        got = materialise(met.select("id", F.col("m.other").alias("segment_id")).join(left.drop("es"), "id"), "weight-nearest")
        shares.append(got.select("zone_id", "segment_id", F.col("n").alias("share")))
        left, reach = materialise(left.join(got, "id", "left_anti"), "weight-left"), reach * 4
    part = reduce(DataFrame.unionByName, shares).groupBy("zone_id", "segment_id").agg(F.sum("share").alias("share"))
    out = s.select("zone_id", "segment_id").join(part, ["zone_id", "segment_id"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)) + alpha)
    total = out.groupBy("zone_id").agg(F.sum("share").alias("total"))
    return out.join(total, "zone_id").select("zone_id", "segment_id", (F.col("share") / F.col("total")).alias("weight"))


def percentile_ranks(df: DataFrame, value: str) -> DataFrame:
    """Adds ``pct``: the mean rank of equal values over the number of rows, from one row per distinct value."""
    per, rows = running_counts(df, value)
    per = per.select(F.col("value").alias("_v"), ((F.col("before") + (F.col("n") + 1) / 2) / F.lit(rows)).alias("pct"))
    return df.join(per, F.col(value) == F.col("_v")).drop("_v")


def within_hops(edges: DataFrame, start: DataFrame, hops: int = 3) -> DataFrame:
    """(segment_id) starts over an edge list (a, b, both ways) to (segment_id, other, hop): least number of hops up to ``hops``.

    A hop goes on from the pairs that the hop before found and that no earlier one had, so no walk is followed twice; it ends
    where nothing new is found. A start is at hop 0 of itself and isn't returned.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = materialise(both, "hop-edges")
    step = start.select("segment_id", F.col("segment_id").alias("other"), F.lit(0).alias("hop")).distinct()
    seen = step = materialise(step, "hop-0")
    for h in range(1, hops + 1):
        met = step.join(both, F.col("other") == F.col("a")).select("segment_id", F.col("b").alias("other")).distinct()
        step = materialise(met.join(seen, ["segment_id", "other"], "left_anti").withColumn("hop", F.lit(h)), f"hop-{h}")
        if step.isEmpty():
            break
        seen = seen.unionByName(step)
    return seen.filter("hop > 0")
