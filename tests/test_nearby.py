import math
import random

import pytest

from lanewright.operators import nearby, spatial

SPOT = "points array<struct<x: double, y: double>>"


@pytest.fixture
def largest(monkeypatch):
    """The rows of each scratch table that the operators write."""
    found = []
    for module in (spatial, nearby):

        def counted(df, label, plain=module.materialise):
            out = plain(df, label)
            found.append((out.count(), label))
            return out

        monkeypatch.setattr(module, "materialise", counted)
    return found


def to_edge(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = min(1, max(0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def apart(a, b, c, d):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
        return 0.0
    return min(to_edge(a, c, d), to_edge(b, c, d), to_edge(c, a, b), to_edge(d, a, b))


def path_distance(p, q):
    return min(apart(*e, *f) for e in zip(p, p[1:], strict=False) for f in zip(q, q[1:], strict=False))


def paths(seed, n, spread, reach):
    r = random.Random(seed)
    at = lambda: (r.uniform(-spread, spread), r.uniform(-spread, spread))
    out = []
    for _ in range(n):
        p = [at()]
        for _ in range(r.choice((1, 1, 1, 3))):
            p.append((p[-1][0] + r.uniform(-reach, reach), p[-1][1] + r.uniform(-reach, reach)))
        out.append(p)
    out[0] = [(0.0, 0.0), (0.0, 0.0)]
    return out


def test_links_equal_all_pairs_and_no_pair_is_kept(rows, monkeypatch, largest):
    """Small blocks, many in a tile; some links have none near, and one segment is far longer than the rest."""
    monkeypatch.setattr(nearby, "BLOCK", 7)
    links, segs = paths(1, 60, 100, 80), paths(2, 90, 100, 80)
    links[-1], segs[-1], near, far = [(400.0, 400.0), (401.0, 400.0)], [(-9000.0, 50.0), (9000.0, 60.0)], 60.0, 500.0
    found = spatial.links_to_segments(rows(f"link_id string, {SPOT}", *[(f"l{i}", p) for i, p in enumerate(links)]), rows(f"segment_id long, {SPOT}", *enumerate(segs)), near=near, far=far)
    got = {(r.link_id, r.segment_id): (round(r.distance_ft, 6), r.mapping_method) for r in found.collect()}
    want = {}
    for i, p in enumerate(links):
        d = {j: path_distance(p, q) for j, q in enumerate(segs)}
        want |= {(f"l{i}", j): (round(x, 6), "buffer") for j, x in d.items() if x <= near}
        if min(d.values()) > near and (m := min((x, j) for j, x in d.items()))[0] <= far:
            want[f"l{i}", m[1]] = round(m[0], 6), "nearest_fallback"
    assert got == want and sum(m == "nearest_fallback" for _, m in got.values()) >= 1
    assert max(largest)[0] < len(got) / 2  # shapes and pairs of blocks, but not the pairs


def test_weights_equal_all_pairs_and_no_pair_is_kept(rows, monkeypatch, largest):
    """Points within reach of most segments of their zone, a few within reach of none, in two zones with the same ids."""
    monkeypatch.setattr(nearby, "BLOCK", 7)
    reach, r, points, segs = 60.0, random.Random(3), [], []
    for zone in (1, 2):
        points += [(zone, r.uniform(-100, 100), r.uniform(-100, 100), r.randint(1, 4)) for _ in range(50)] + [(zone, 700.0 + zone, 0.0, 3), (zone, -9000.0, 5.0, 2)]
        segs += [(zone, f"s{i}", p) for i, p in enumerate(paths(zone + 3, 50, 100, 80))]
    got = {(x.zone_id, x.segment_id): x.weight for x in spatial.share_weights(rows("zone_id int, x double, y double, n int", *points), rows(f"zone_id int, segment_id string, {SPOT}", *segs), reach=reach).collect()}
    share = {(z, s): 1.0 for z, s, _ in segs}
    for zone, x, y, n in points:
        d = sorted((min(to_edge((x, y), a, b) for a, b in zip(p, p[1:], strict=False)), s) for z, s, p in segs if z == zone)
        near = [(1 / (e + 1), s) for e, s in d if e <= reach] or [(1.0, d[0][1])]
        for w, s in near:
            share[zone, s] += n * w / sum(w for w, _ in near)
    total = {zone: sum(v for (z, _), v in share.items() if z == zone) for zone in (1, 2)}
    assert got == {k: pytest.approx(v / total[k[0]]) for k, v in share.items()}
    assert max(largest)[0] < 1000
