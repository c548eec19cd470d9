"""Near pairs of shapes, block by block.

Shapes of a tile make blocks of about ``BLOCK``; blocks whose boxes come within reach of each other meet by an equi join on
cells of their own sizes, each pair of blocks once, so each pair of shapes is measured once and no pair is shuffled to find
repeats. Inside a pair of blocks distances are arrays of at most some ``CHUNK`` numbers. A shape is (id, es), its edges as in
``geo.edges``; a point is an edge without length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions import geometry as geo
from lanewright.scratch import materialise

BLOCK, CHUNK = 2048, 1 << 15
#: Pairs of blocks a task takes at most, on average.
TASK_PAIRS = 64


def shapes_of(df: DataFrame, by: list[str], key: str, es: Column) -> DataFrame:
    """(by, id, es): the finite edges of each id; rows of one id are one shape, and one without edges is left out."""
    fine = F.filter(es, lambda e: geo.finite(*[e[c] for c in ("ax", "ay", "bx", "by")]))
    g = df.select(*by, F.col(key).alias("id"), fine.alias("es")).filter("id IS NOT NULL AND size(es) > 0")
    return g.groupBy(*by, "id").agg(F.flatten(F.collect_list("es")).alias("es"))


def blocks(shapes: DataFrame, by: list[str], size: float) -> DataFrame:
    """(by, id, es, ...) to (by, block, box, items): the shapes of a tile, ``size`` wide, in as many blocks as it needs."""
    least = lambda a, b: F.array_min(F.transform("es", lambda e: F.least(e[a], e[b])))
    most = lambda a, b: F.array_max(F.transform("es", lambda e: F.greatest(e[a], e[b])))
    s = shapes.select(*by, F.struct(*[c for c in shapes.columns if c not in by]).alias("item"), least("ax", "bx").alias("x0"), least("ay", "by").alias("y0"), most("ax", "bx").alias("x1"), most("ay", "by").alias("y1"))
    tile = [*by, "tx", "ty"]
    s = materialise(s.withColumns({"tx": F.floor(F.col("x0") / size), "ty": F.floor(F.col("y0") / size)}), "near-shapes")
    parts = s.groupBy(*tile).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    s = s.join(parts, tile).withColumn("part", F.pmod(F.xxhash64("item.id"), F.col("parts")))
    box = F.struct(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    g = s.groupBy(*tile, "part").agg(box.alias("box"), F.array_sort(F.collect_list("item")).alias("items"))
    return materialise(g.select(*by, F.monotonically_increasing_id().alias("block"), "box", "items"), "near-blocks")


def _meeting(a: DataFrame, b: DataFrame, by: list[str], reach: float) -> DataFrame:
    """(by, a, b, left, right): the pairs of blocks whose boxes are within reach, with their shapes."""
    least = max(geo.FINEST, math.ceil(math.log2(reach))) if reach else geo.FINEST
    level = F.greatest(geo.level_of(F.greatest(F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0"))), F.lit(least))
    heads = [df.select(*by, F.col("block").alias(k), F.col("box").alias(f"{k}_box"), level.alias("level")) for k, df in (("a", a), ("b", b))]
    levels = [sorted(r[0] for r in h.select("level").distinct().collect()) or [least] for h in heads]  # a few dozen at most
    # two blocks meet at the level of the wider one, where both have a few cells
    at = lambda others: F.explode(F.array_distinct(F.transform(F.array(*[F.lit(k) for k in others]), lambda k: F.greatest(k, F.col("level"))))).alias("at")
    cells = [h.select(*by, k, f"{k}_box", at(other)).select("*", F.explode(geo.level_cells(F.col(f"{k}_box"), pad, F.col("at"))).alias("c")) for h, k, other, pad in ((heads[0], "a", levels[1], reach), (heads[1], "b", levels[0], 0.0))]
    met = cells[0].join(cells[1], [*by, "at", "c"])
    for lo, hi in (("x0", "x1"), ("y0", "y1")):
        met = met.filter((F.col(f"a_box.{lo}") - reach <= F.col(f"b_box.{hi}")) & (F.col(f"b_box.{lo}") - reach <= F.col(f"a_box.{hi}")))
    met = materialise(met.select("a", "b").distinct(), "near-met")
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(met.count() / TASK_PAIRS))
    full = met.join(a.select(F.col("block").alias("a"), *by, F.col("items").alias("left")), "a").join(b.select(F.col("block").alias("b"), F.col("items").alias("right")), "b")
    return full.repartition(tasks, "a", "b")  # a stated number: the pairs are few bytes and much work


def _shapes(cell) -> tuple:
    """Ids, where each shape's edges begin, the number of edges, and the edges' columns, of one array of shapes."""
    items = cell.values
    es = items.field("es")
    starts, flat = es.offsets.to_numpy(), es.flatten()
    return items, starts[:-1] - starts[0], len(flat), [flat.field(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")]


def _to_edges(e: list, x, y):
    """Squared distances of points to edges."""
    ax, ay, dx, dy, q = e
    px, py = x - ax, y - ay
    t = px * dx
    t += py * dy
    t /= q
    np.clip(t, 0.0, 1.0, out=t)
    px -= t * dx
    py -= t * dy
    px *= px
    py *= py
    px += py
    return px


def _apart(p, q):
    return ((p > 0) & (q < 0)) | ((p < 0) & (q > 0))


def _squares(a: list, b: list, points: bool):
    """Squared distances of edges ``a`` (down) and ``b`` (across); as ``geo.lines_distance`` for an edge and an edge."""
    (ax, ay, bx, by), (cx, cy, ex, ey) = [v[:, None] for v in a], [v[None, :] for v in b]
    long = lambda dx, dy: np.where((q := dx * dx + dy * dy) == 0, 1.0, q)
    dx, dy = ex - cx, ey - cy
    other = [cx, cy, dx, dy, long(dx, dy)]
    s = _to_edges(other, ax, ay)
    if points:
        return s
    np.minimum(s, _to_edges(other, bx, by), out=s)
    gx, gy = bx - ax, by - ay
    own = [ax, ay, gx, gy, long(gx, gy)]
    np.minimum(s, _to_edges(own, cx, cy), out=s)
    np.minimum(s, _to_edges(own, ex, ey), out=s)
    cross = _apart(gx * (cy - ay) - gy * (cx - ax), gx * (ey - ay) - gy * (ex - ax))
    cross &= _apart(dx * (ay - cy) - dy * (ax - cx), dx * (by - cy) - dy * (bx - cx))
    s[cross] = 0.0
    return s


def _distances(left, right, points: bool) -> Iterator[tuple]:
    """(first, distances) for some shapes of ``left`` at a time, from the first on, to all shapes of ``right``."""
    _, la, na, a = left
    _, lb, nb, b = right
    n = len(la)
    ends = np.append(la, na)
    step = max(1, CHUNK // max(1, nb) * n // na)
    for i in range(0, n, step):
        j = min(n, i + step)
        s = _squares([v[ends[i]:ends[j]] for v in a], b, points)
        if ends[j] - ends[i] > j - i:
            s = np.minimum.reduceat(s, ends[i:j] - ends[i], axis=0)
        if nb > len(lb):
            s = np.minimum.reduceat(s, lb, axis=1)
        yield i, np.sqrt(s)


def _run(a: DataFrame, b: DataFrame, by: list[str], reach: float, points: bool, ddl: str, emit) -> DataFrame:
    """``emit(distances, left, right, first)`` gives the columns after ``by`` for each chunk of each pair of blocks."""
    types = dict(a.dtypes)

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = _shapes(batch.column("left")[i]), _shapes(batch.column("right")[i])
                for first, d in _distances(left, right, points):
                    columns = emit(d, left[0], right[0], first)
                    if len(columns[0]):
                        yield pa.RecordBatch.from_arrays([*[pa.repeat(batch.column(c)[i], len(columns[0])) for c in by], *columns], names)

    schema = ", ".join([*[f"`{c}` {types[c]}" for c in by], ddl])
    names = [*by, *[part.split()[0] for part in ddl.split(", ")]]
    return _meeting(a, b, by, reach).select(*by, "left", "right").mapInArrow(work, schema)


def _id(df: DataFrame) -> str:
    return df.schema["items"].dataType.elementType["id"].dataType.simpleString()


def within(a: DataFrame, b: DataFrame, reach: float, by: list[str] = (), points: bool = False) -> DataFrame:
    """(by, id, other, d): all pairs of shapes of two tables of blocks within reach."""

    def emit(d, left, right, first):
        i, j = np.nonzero(d <= reach)
        return [left.field("id").take(pa.array(i + first)), right.field("id").take(pa.array(j)), pa.array(d[i, j])]

    return _run(a, b, list(by), reach, points, f"id {_id(a)}, other {_id(b)}, d double", emit)


def nearest(a: DataFrame, b: DataFrame, reach: float, by: list[str] = (), points: bool = False) -> DataFrame:
    """(by, id, m: (d, other), pull): the nearest shape of ``b`` within reach, least id on ties, and the sum of 1 / (d + 1) of all within reach."""

    def emit(d, left, right, first):
        at = d.argmin(axis=1)  # the first of the least: items are in the order of their ids
        m = d[np.arange(len(d)), at]
        i = np.nonzero(m <= reach)[0]
        pull = np.where(d[i] <= reach, 1 / (d[i] + 1), 0.0).sum(axis=1)
        return [left.field("id").take(pa.array(i + first)), right.field("id").take(pa.array(at[i])), pa.array(m[i]), pa.array(pull)]

    rows = _run(a, b, list(by), reach, points, f"id {_id(a)}, other {_id(b)}, d double, pull double", emit)
    return rows.groupBy(*by, "id").agg(F.min(F.struct("d", "other")).alias("m"), F.sum("pull").alias("pull"))


def pulled(a: DataFrame, b: DataFrame, reach: float, by: list[str] = (), points: bool = False) -> DataFrame:
    """(by, other, share): for each shape of ``b`` the sum over those of ``a`` within reach of their ``v`` / (d + 1)."""

    def emit(d, left, right, first):
        w = np.where(d <= reach, 1 / (d + 1), 0.0)
        share = left.field("v").to_numpy(zero_copy_only=False)[first:first + len(d)] @ w
        j = np.nonzero(w.any(axis=0))[0]
        return [right.field("id").take(pa.array(j)), pa.array(share[j])]

    rows = _run(a, b, list(by), reach, points, f"other {_id(b)}, share double", emit)
    return rows.groupBy(*by, "other").agg(F.sum("share").alias("share"))
