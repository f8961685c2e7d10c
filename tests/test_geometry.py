"""Geometry job (G1-G12): parsing, repair, orientation, area, Douglas-Peucker
significance against a direct implementation, crossings against brute force,
the reduction ladder and the key check."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.functions.geo_rings import ring_crossings, unwrap
from terrafold.functions.geo_udf import arc_dist, significance, unit_vectors
from terrafold.operators import geometry as G


def dp_direct(x, y, t):
    """Plain recursive Douglas-Peucker at tolerance t (segment distance)."""
    from terrafold.functions.geo_udf import seg_dist

    keep = {0, len(x) - 1}

    def rec(lo, hi):
        if hi - lo < 2:
            return
        d = seg_dist(x[lo + 1:hi], y[lo + 1:hi], x[lo], y[lo], x[hi], y[hi])
        k = int(np.argmax(d))
        if d[k] > t:
            keep.add(lo + 1 + k)
            rec(lo, lo + 1 + k)
            rec(lo + 1 + k, hi)
    rec(0, len(x) - 1)
    return sorted(keep)


@pytest.mark.parametrize("seed", range(40))
def test_significance_matches_direct_dp(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(4, 60))
    x = np.cumsum(rng.normal(0, 50, n))
    y = np.cumsum(rng.normal(0, 50, n))
    x[-1], y[-1] = x[0], y[0]
    sig = significance(x, y)
    for t in (5, 10, 25, 50, 100, 500):
        assert sorted(np.flatnonzero(sig > t).tolist()) == dp_direct(x, y, t)


def brute_crossings(x, y):
    m = len(x) - 1
    out = []

    def orient(a, b, c):
        return np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    for i in range(m):
        for j in range(i + 2, m):
            if i == 0 and j == m - 1:
                continue
            a, b, c, d = (x[i], y[i]), (x[i + 1], y[i + 1]), (x[j], y[j]), (x[j + 1], y[j + 1])
            box = (min(a[0], b[0]) <= max(c[0], d[0]) and min(c[0], d[0]) <= max(a[0], b[0])
                   and min(a[1], b[1]) <= max(c[1], d[1]) and min(c[1], d[1]) <= max(a[1], b[1]))
            if box and orient(a, b, c) * orient(a, b, d) <= 0 and orient(c, d, a) * orient(c, d, b) <= 0:
                out.append((i, j))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_crossings_match_brute_force(seed):
    rng = np.random.default_rng(100 + seed)
    n = int(rng.integers(4, 30))
    x, y = rng.integers(0, 20, n).astype(float), rng.integers(0, 20, n).astype(float)
    x = np.append(x, x[0])
    y = np.append(y, y[0])
    assert ring_crossings(x, y) == brute_crossings(x, y)


@pytest.mark.parametrize("seed", range(30))
def test_proper_crossings_match_brute_force(seed):
    rng = np.random.default_rng(500 + seed)
    n = int(rng.integers(4, 12))
    x, y = rng.integers(0, 9, n).astype(float), rng.integers(0, 9, n).astype(float)
    x, y = np.append(x, x[0]), np.append(y, y[0])

    def side(i, k):
        return (x[i + 1] - x[i]) * (y[k] - y[i]) - (y[i + 1] - y[i]) * (x[k] - x[i])
    want = any(side(i, j) * side(i, j + 1) < 0 and side(j, i) * side(j, i + 1) < 0 for i, j in brute_crossings(x, y))
    assert bool(ring_crossings(x, y, proper=True)) == want


def test_unwrap_only_shifts_whole_turns():
    assert unwrap([10.1, 20.3, 10.1]).tolist() == [10.1, 20.3, 10.1]
    assert unwrap([179.5, -179.5, -179.0, 179.5]).tolist() == [179.5, 180.5, 181.0, 179.5]
    assert len(unwrap([])) == 0


def test_self_crossing_rings_are_rejected_and_touching_ones_published(spark):
    rows = [("bow", "POLYGON ((0 0, 2 1, 2 0, 0 2, 0 0))"), ("ok", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
            ("touch", "POLYGON ((0 0, 4 0, 2 2, 4 4, 0 4, 2 2, 0 0))"),
            ("bow-dateline", "POLYGON ((179.9 0, -179.9 1, -179.9 0, 179.7 1, 179.9 0))")]
    table, rejects = G.shapes(spark.createDataFrame(rows, "geo_id string, geoloc string"))
    assert {r["geo_id"]: r["problem"] for r in rejects.collect()} == {
        "bow": "ring crosses itself", "bow-dateline": "ring crosses itself"}
    assert {r["id"] for r in table.collect()} == {"ok", "touch"}


def test_distances_take_the_short_way_over_the_antimeridian():
    v = unit_vectors([179.5, -179.5, -179.4], [0.0, 0.0, 0.0])
    assert 100_000 < arc_dist(v[1:2], v[0], v[0])[0] < 120_000
    assert arc_dist(v[1:2], v[0], v[2])[0] < 1e-6


ROWS = [
    ("ccw", "POLYGON ((0 0, 1 0, 1 0, 1 1, 0 1, 0 0))"),
    ("cw", "POLYGON ((0 0, 0 1, 1 1, 1 0, 0 0))"),
    ("hole", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5, 1.5 0.5, 1.5 1.5, 0.5 1.5, 0.5 0.5))"),
    ("multi", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((10 10, 11 10, 11 11, 10 11, 10 10)))"),
    ("open", "POLYGON ((0 0, 1 0, 1 1, 0 1))"),
    ("flat", "POLYGON ((0 0, 1 0, 2 0, 0 0))"),
    ("bad", "POLYGON ((0 0, 1 x, 1 1))"),
    ("null", None),
    ("point", "POINT (1 2)"),
    ("z", "POLYGON ((0 0 1, 1 0 1, 1 1 1, 0 0 1))"),
    ("unbalanced", "POLYGON ((0 0, 1 0, 1 1, 0 0)"),
    ("extra_paren", "POLYGON ((0 0, 1 0, 1 1, 0 0)))"),
    ("dateline", "POLYGON ((179.5 0, -179.5 0, -179.5 1, 179.5 1, 179.5 0))"),
]


@pytest.fixture(scope="module")
def shapes_df(spark):
    return spark.createDataFrame(ROWS, "geo_id string, geoloc string")


def test_parse_rejects(shapes_df):
    ok, rej = G.vertices_shapes(shapes_df)
    got = {r["geo_id"]: r["problem"] for r in rej.collect()}
    assert got == {"bad": "bad coordinate", "null": "null text", "point": "unsupported type",
                   "z": "bad coordinate", "unbalanced": "unbalanced parentheses",
                   "extra_paren": "unbalanced parentheses"}
    assert ok.count() == len(ROWS) - len(got)


def test_clean_orient_area(shapes_df):
    ok, _ = G.vertices_shapes(shapes_df)
    c = {r["geo_id"]: r for r in G.clean(ok).collect()}
    one_deg = c["ccw"]["area_m2"]
    assert abs(one_deg - 1.2364e10) / 1.2364e10 < 1e-3          # ~111.2 km x 111.2 km at the equator
    assert c["cw"]["area_m2"] == pytest.approx(one_deg)         # reoriented, same area
    assert [(p.x, p.y) for p in c["cw"]["shape"][0][0]] == [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    assert len(c["ccw"]["shape"][0][0]) == 5                     # repeated point dropped
    assert c["open"]["shape"][0][0][-1] == c["open"]["shape"][0][0][0]   # closed
    assert c["hole"]["area_m2"] == pytest.approx(4 * one_deg - one_deg, rel=1e-3)
    assert c["flat"]["shape"] == []                              # zero area -> dropped
    assert c["dateline"]["area_m2"] == pytest.approx(one_deg, rel=1e-3)


def test_shape_table_and_wkt(shapes_df):
    table, rej = G.shapes(shapes_df)
    t = {r["id"]: r for r in table.collect()}
    assert t["cw"]["geoloc"] == "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"
    assert t["multi"]["geoloc"].startswith("MULTIPOLYGON (((0 0")
    assert t["ccw"]["geoloc_reduced_level"] == 500
    assert {r["geo_id"] for r in rej.collect()} >= {"flat", "bad", "null"}


def spike(side_deg, depth_m):
    d = depth_m / (6371008.8 * math.pi / 180)
    pts = [(0, 0), (side_deg / 2, -d), (side_deg, 0), (side_deg, side_deg), (0, side_deg), (0, 0)]
    return "POLYGON ((" + ", ".join(f"{x:.9f} {y:.9f}" for x, y in pts) + "))"


def test_ladder_levels(spark):
    cases = [(0.01, 30, 500), (0.01, 200, 100), (0.01, 80, 50), (0.002, 30, 25), (0.001, 8, 5), (0.0005, 4, 1)]
    df = spark.createDataFrame([(str(i), spike(s, d)) for i, (s, d, _) in enumerate(cases)], "geo_id string, geoloc string")
    ok, _ = G.vertices_shapes(df)
    r = {x["geo_id"]: x["reduced_level"] for x in G.reduce(G.significance(G.clean(ok))).collect()}
    assert r == {str(i): lvl for i, (_, _, lvl) in enumerate(cases)}


def test_reduced_area_matches_reduced_shape(spark):
    df = spark.createDataFrame([("a", spike(0.01, 200))], "geo_id string, geoloc string")
    ok, _ = G.vertices_shapes(df)
    s = G.significance(G.clean(ok))
    r = s.select(F.expr(geo.reduced_area("shape", "sig", "100D")).alias("a1"),
                 F.expr(geo.shape_area(geo.reduce_shape("shape", "sig", "100D"))).alias("a2")).first()
    assert r["a1"] == pytest.approx(r["a2"])


def test_crossings_operator(spark):
    df = spark.createDataFrame([("bow", "POLYGON ((0 0, 2 1, 2 0, 0 2, 0 0))")], "geo_id string, geoloc string")
    ok, _ = G.vertices_shapes(df)
    assert [tuple(r) for r in G.crossings(G.clean(ok), "geo_id").collect()] == [("bow", 0, 0, 0, 2)]


def test_key_violations(spark):
    df = spark.createDataFrame([("01", "a"), ("01", "a"), ("02", "b"), (None, "c")], "fips_code string, id string")
    got = sorted((r["id"], r["rule"], r["n"]) for r in G.key_violations(df).collect())
    assert got == [("a", "duplicate key", 2), ("c", "null key", 1)]


def test_area_invariant_to_start_vertex(spark):
    rng = np.random.default_rng(7)
    ang = np.sort(rng.uniform(0, 2 * np.pi, 12))
    pts = [(10 + 0.3 * math.cos(a), 45 + 0.2 * math.sin(a)) for a in ang]
    rows = []
    for k in range(len(pts)):
        ring = pts[k:] + pts[:k]
        ring = ring + [ring[0]]
        rows.append((str(k), "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))"))
    ok, _ = G.vertices_shapes(spark.createDataFrame(rows, "geo_id string, geoloc string"))
    areas = [r["area_m2"] for r in G.clean(ok).collect()]
    assert len(areas) == len(pts)
    assert max(areas) - min(areas) < 1e-6 * max(areas)


def test_many_holes_do_not_overflow(spark):
    """Thousands of rings in one polygon: parsing must not recurse per ring."""
    n = 5000
    at = [round(x * 0.03, 2) for x in range(n)]  # within the range of longitudes
    holes = ", ".join(f"({x:.2f}1 0.1, {x:.2f}1 0.2, {x:.2f}2 0.2, {x:.2f}2 0.1, {x:.2f}1 0.1)" for x in at)
    df = spark.createDataFrame([("a", f"POLYGON ((-1 0, 170 0, 170 1, -1 1, -1 0), {holes})")],
                               "geo_id string, geoloc string")
    ok, rej = G.vertices_shapes(df)
    assert rej.count() == 0
    assert G.clean(ok).select(F.size(F.get("shape", 0))).first()[0] == n + 1


def test_wkb_round_trip_and_bytes(spark):
    import struct

    rng = np.random.default_rng(2)
    odd = [0.0, -0.0, 1.0, -1.0, 0.1, 179.99999999999997, -180.0, 1e-300, 2.0**-1022, 0.9999999999999999, 1.0000000000000002, 3.0, 64.0, 63.99999999999999, 1 / 3, -1e-7]
    rings = [[(float(a), float(b)) for a, b in rng.uniform(-180, 180, (n, 2))] for n in (4, 9, 300)] + [[(a, b) for a in odd for b in (odd[5], odd[7])]]
    shapes = [[[rings[0]]], [[rings[1], rings[0]], [rings[2]]], [[rings[3]]], [[rings[0]] * 40]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)] + [(9, [])], f"id int, shape {geo.SHAPE.simpleString()}")
    s = G.once(G.once(df, wkb=geo.to_wkb("shape")), back=geo.from_wkb("wkb"))
    got = {r["id"]: r for r in s.collect()}

    def polygon(part):
        return b"\x00" + struct.pack(">II", 3, len(part)) + b"".join(struct.pack(">I", len(r)) + b"".join(struct.pack(">dd", x + 0.0, y + 0.0) for x, y in r) for r in part)
    for i, shape in enumerate(shapes):
        want = polygon(shape[0]) if len(shape) == 1 else b"\x00" + struct.pack(">II", 6, len(shape)) + b"".join(map(polygon, shape))
        assert bytes(got[i]["wkb"]) == want
        assert [[[tuple(p) for p in r] for r in part] for part in got[i]["back"]] == [[[(x, y) for x, y in r] for r in part] for part in shape]
    assert got[9]["wkb"] is None and got[9]["back"] is None
