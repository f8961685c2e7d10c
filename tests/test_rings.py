"""Rings against each other and around the poles (G2-G7): grid pairs against all pairs, fitting of rings against rectangles,
distances against vectors, the ladder over reductions that come out invalid, the report over tiles."""

import math
import time

import numpy as np
import pytest

from terrafold.functions import geo_rings as R
from terrafold.functions.geo_udf import arc_dist, reduced_rings, shape_problem, unit_vectors
from terrafold.operators import geometry as G

R2 = 6371008.8 ** 2


@pytest.mark.parametrize("seed", range(12))
def test_grid_finds_every_pair_of_edges_whose_boxes_meet_where_they_touch(seed):
    rng = np.random.default_rng(seed)
    n = 120
    scale = 10.0 ** rng.integers(-4, 3)
    ax, ay = rng.integers(0, 25, n) * scale, rng.integers(0, 25, n) * scale
    long_ = rng.integers(-12, 13, (2, n)) * (rng.random(n) < 0.2) + rng.integers(-2, 3, (2, n))
    bx, by = ax + long_[0] * scale, ay + long_[1] * scale
    got = {tuple(p) for p in R.crossing_pairs(ax, ay, bx, by, lambda i, j: i < 0).tolist()}
    want = set()
    for i in range(n):
        for j in range(i + 1, n):
            boxes = (min(ax[i], bx[i]) <= max(ax[j], bx[j]) and min(ax[j], bx[j]) <= max(ax[i], bx[i])
                     and min(ay[i], by[i]) <= max(ay[j], by[j]) and min(ay[j], by[j]) <= max(ay[i], by[i]))
            o = [R._side(ax[i], ay[i], bx[i], by[i], ax[j], ay[j]), R._side(ax[i], ay[i], bx[i], by[i], bx[j], by[j]),
                 R._side(ax[j], ay[j], bx[j], by[j], ax[i], ay[i]), R._side(ax[j], ay[j], bx[j], by[j], bx[i], by[i])]
            if boxes and o[0] * o[1] <= 0 and o[2] * o[3] <= 0:
                want.add((i, j))
    assert got == want


def zigzag(n):
    x = np.arange(n) * (150.0 / n)
    y = np.where(np.arange(n) % 2 == 0, 0.0, 1.0)
    return np.concatenate([x, [x[-1], 0.0, 0.0]]), np.concatenate([y, [-1.0, -1.0, 0.0]])


def test_a_zigzag_ring_of_a_million_vertices_is_near_linear():
    took = {}
    for n in (100_000, 1_000_000):
        x, y = zigzag(n)
        t = time.perf_counter()
        assert R.ring_crossings(x, y, proper=True) == []
        took[n] = time.perf_counter() - t
    assert took[1_000_000] < 40 * max(took[100_000], 0.05)
    x, y = zigzag(1_000_000)
    y[500_000] = -3.0
    assert R.ring_crossings(x, y, proper=True)


def box(x, y, w, h):
    return np.array([x, x + w, x + w, x, x], float), np.array([y, y, y + h, y + h, y], float)


def turned(ring, angle, size=0.013, at=(30.0, 40.0)):
    x, y = ring
    c, s = math.cos(angle), math.sin(angle)
    return at[0] + size * (c * x - s * y), at[1] + size * (s * x + c * y)


def share(a, b):
    return a[0] < b[0] + b[2] and b[0] < a[0] + a[2] and a[1] < b[1] + b[3] and b[1] < a[1] + a[3]


def within(a, b):
    return b[0] <= a[0] and b[1] <= a[1] and a[0] + a[2] <= b[0] + b[2] and a[1] + a[3] <= b[1] + b[3]


@pytest.mark.parametrize("angle", [0.0, 0.3, 1.1])
def test_rectangles_fit_exactly_when_their_insides_say_so(angle):
    rng = np.random.default_rng(7)
    for _ in range(400):
        a, b = ([int(v) for v in (*rng.integers(0, 7, 2), *rng.integers(1, 6, 2))] for _ in range(2))
        parts = R.ring_fault([[turned(box(*a), angle)], [turned(box(*b), angle)]])
        assert parts == ("parts overlap" if share(a, b) else None), (a, b)
        hole = R.ring_fault([[turned(box(*a), angle), turned(box(*b), angle)]])
        if within(b, a) and a != b:
            assert hole is None, (a, b)
        elif a == b or not share(a, b) or within(a, b):
            assert hole == "hole outside its shell", (a, b)
        else:
            assert hole == "hole crosses its shell", (a, b)
        shell = turned(box(-1, -1, 20, 20), angle)
        holes = R.ring_fault([[shell, turned(box(*a), angle), turned(box(*b), angle)]])
        assert holes == ("holes overlap" if share(a, b) else None), (a, b)


def test_a_part_inside_another_part_s_hole_fits():
    shell, hole, island = box(0, 0, 10, 10), box(2, 2, 6, 6), box(3, 3, 2, 2)
    assert R.ring_fault([[shell, hole], [island]]) is None
    assert R.ring_fault([[shell, hole], [box(2, 2, 6, 6)]]) is None          # fills the hole
    assert R.ring_fault([[shell, hole], [box(1, 3, 3, 2)]]) == "parts overlap"
    assert R.ring_fault([[shell], [island]]) == "parts overlap"
    assert R.ring_fault([[shell, hole], [shell, hole]]) == "parts overlap"
    diamond = np.array([5, 10, 5, 0, 5.0]), np.array([0, 5, 10, 5, 0.0])
    assert R.ring_fault([[shell, diamond]]) is None                          # touches in four points
    notch = np.array([0, 10, 10, 5, 0, 0.0]), np.array([0, 0, 10, 4, 10, 0.0])
    assert R.ring_fault([[notch, (np.array([0, 10, 5, 0.0]), np.array([10, 10, 0, 10.0]))]]) == "hole crosses its shell"


def test_rings_meet_over_the_antimeridian():
    a, b = (box(179.0, 0, 2, 2), box(-180.5, 1, 2, 2))
    wrapped = (np.where(a[0] > 180, a[0] - 360, a[0]), a[1])
    assert R.ring_fault([[wrapped], [b]]) == "parts overlap"
    assert R.ring_fault([[wrapped], [box(-178.5, 1, 2, 2)]]) is None


POLAR = {"north_east": ("POLYGON ((0 80, 90 80, 180 80, -90 80, 0 80))", 80), "north_west": ("POLYGON ((0 80, -90 80, 180 80, 90 80, 0 80))", 80),
         "south_west": ("POLYGON ((0 -70, -90 -70, 180 -70, 90 -70, 0 -70))", 70), "south_east": ("POLYGON ((0 -70, 90 -70, 180 -70, -90 -70, 0 -70))", 70)}


def test_polar_rings_take_the_cap(spark):
    df = spark.createDataFrame([(k, w) for k, (w, _) in POLAR.items()], "geo_id string, geoloc string")
    ok, _ = G.vertices_shapes(df)
    got = {r["geo_id"]: r for r in G.clean(ok).collect()}
    for k, (_, lat) in POLAR.items():
        assert got[k]["area_m2"] == pytest.approx(2 * math.pi * R2 * (1 - math.sin(math.radians(lat))), rel=1e-9)
        # the pole on the left: north caps run east, south caps west
        lon = [p.x for p in got[k]["shape"][0][0]]
        step = (lon[1] - lon[0] + 180) % 360 - 180
        assert (step > 0) == k.startswith("north")
    with_hole = "POLYGON ((0 80, 90 80, 180 80, -90 80, 0 80), (0 85, 90 85, 180 85, -90 85, 0 85))"
    outside = "POLYGON ((0 80, 90 80, 180 80, -90 80, 0 80), (0 75, 5 75, 5 78, 0 78, 0 75))"
    table, rejects = G.shapes(spark.createDataFrame([("band", with_hole), ("out", outside)], "geo_id string, geoloc string"))
    assert [r["id"] for r in table.collect()] == ["band"]
    assert {r["geo_id"]: r["problem"] for r in rejects.collect()} == {"out": "hole outside its shell"}


def test_polar_ring_crossing_itself_over_its_seam():
    # the last edge leads back to the start over the first one
    x = np.array([0.0, 100, 200, 300, 365, 360])
    y = np.array([80.0, 75, 75, 75, 78, 80])
    assert R.ring_crossings(x, y, proper=True) == [] and R.ring_crossings(*zigzag(8)) == []
    y2 = np.array([80.0, 75, 75, 75, 81, 80])
    x2 = np.array([0.0, 100, 200, 300, 390, 360])
    assert R.ring_crossings(x2, y2, proper=True)


def test_distances_are_those_of_great_circles():
    rng = np.random.default_rng(3)
    for lat, span in ((0, 1e-5), (70, 0.01), (89.9, 0.1), (40, 30), (60, 100)):
        lon = rng.uniform(-span, span, 60)
        la = np.clip(lat + rng.uniform(-span, span, 60) / 2, -90, 90)
        v = unit_vectors(lon, la)
        a, b = v[0], v[1]
        got = arc_dist(v[2:], a, b)
        # the least angle to dense points of the arc
        w = math.acos(max(-1.0, min(1.0, float(a @ b)))) or 1e-12
        t = np.linspace(0, 1, 20001)[:, None]
        arc = (np.sin((1 - t) * w) * a + np.sin(t * w) * b) / math.sin(w) if w > 1e-6 else a + t * (b - a)
        for d, p in zip(got, v[2:]):
            near = 6371008.8 * 2 * np.arcsin(np.sqrt(((arc - p) ** 2).sum(axis=1).min()) / 2)
            assert d <= near + 1e-6 and near - d < 1e-3 * max(1.0, w * 6371008.8 / 100)


def test_a_rung_with_an_invalid_reduction_is_skipped(spark):
    # a notch 150 m deep holds the tip of a large wedge: at 500 m the notch closes over the tip
    notch = "((0 0, 0.02 0, 0.02 0.02, 0.013 0.02, 0.01 0.01865, 0.007 0.02, 0 0.02, 0 0))"
    df = spark.createDataFrame([("in", f"MULTIPOLYGON ({notch}, ((0.01 0.0188, 0.016 0.03, 0.004 0.03, 0.01 0.0188)))"),
                                ("above", f"MULTIPOLYGON ({notch}, ((0.01 0.0288, 0.016 0.04, 0.004 0.04, 0.01 0.0288)))")], "geo_id string, geoloc string")
    table, rejects = G.shapes(df)
    assert {r["id"]: r["geoloc_reduced_level"] for r in table.collect()} == {"in": 100, "above": 500} and rejects.count() == 0
    s = G.significance(G.clean(G.vertices_shapes(df)[0]))
    for r in G.reduce(s, ladder=()).collect():
        x, y = ([[[getattr(p, a) for p in ring] for ring in part] for part in r["shape"]] for a in "xy")
        assert (shape_problem(*reduced_rings(x, y, r["sig"], 500.0)) == "parts overlap") == (r["geo_id"] == "in")


def test_crossings_over_tiles_equal_those_of_one_row(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(4):
        pts = [(float(a), float(b)) for a, b in rng.integers(-40, 40, (60, 2))]
        rows.append((f"r{k % 3}", "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in [*pts, pts[0]]) + "))"))
    rows += [rows[0], ("dateline", "POLYGON ((179.9 0, -179.9 1, -179.9 0, 179.7 1, 179.9 0))"), ("ok", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")]
    df = G.clean(G.vertices_shapes(spark.createDataFrame(rows, "geo_id string, geoloc string"))[0])
    monkeypatch.setattr(G, "TILE_EDGES", 5)
    whole = sorted(tuple(r) for r in G.crossings(df, "geo_id").collect())
    tiled = sorted(tuple(r) for r in G.crossings(df, "geo_id", split_edges=3).collect())
    assert whole == tiled and len(whole) > 100


def test_key_gate(spark):
    ok = spark.createDataFrame([("01", "a"), ("02", "a")], "fips_code string, id string")
    G.check_keys(ok)
    with pytest.raises(G.KeyViolations) as e:
        G.check_keys(ok.unionByName(ok))
    assert e.value.violations.count() == 2
