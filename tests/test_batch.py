"""The kernels over a whole batch against those over one shape."""

import math

import numpy as np
import pyarrow as pa
import pytest

from terrafold.functions import geo_batch as B
from terrafold.functions import geo_udf as U

SHAPE = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def placed(ring, angle, size, at):
    c, s = math.cos(angle), math.sin(angle)
    points = [(at[0] + size * (c * x - s * y), at[1] + size * (s * x + c * y)) for x, y in ring]
    return [((x + 180) % 360 - 180 if abs(x) > 180 else x, y) for x, y in points]


def some_ring(rng):
    kind = rng.integers(0, 4)
    if kind < 2:
        return box(*(int(v) for v in (*rng.integers(0, 7, 2), *rng.integers(1, 6, 2))))
    if kind == 2:
        return box(-1, -1, 20, 20)
    n = int(rng.integers(4, 80 if rng.random() < 0.1 else 9))  # the larger ones go one by one
    if rng.random() < 0.7:
        points = [(4 + 4 * math.cos(t), 4 + 4 * math.sin(t)) for t in np.sort(rng.random(n) * 2 * math.pi)]
    else:
        points = [(float(a), float(b)) for a, b in rng.integers(0, 99, (n, 2))]
    return points + [points[0]]


def some_shapes(rng, n):
    out = [None, []]
    for k in range(n):
        angle, size = rng.choice([0, 0, 0.3, 1.1]), rng.choice([1, 0.013, 1e-3])
        at = rng.choice([30, 179.9, -179.95]), rng.choice([40, 0, -30.5])
        shape = [[placed(some_ring(rng), angle, size, at) for _ in range(rng.choice([1, 2, 3]))] for _ in range(rng.choice([1, 1, 2, 3]))]
        if k % 40 == 0:  # around a pole, with or without a hole
            shape = [[[(lon - 180 if lon < 360 else -180, 80.0 + lon % 7) for lon in range(0, 361, 45)]] + [placed(box(0, 0, 2, 2), 0, 1, (10, 86))] * (k % 80 // 40)]
        out.append(shape)
    return out


def axes(shape):
    return [[[np.array([q[i] for q in r], float) for r in p] for p in shape] for i in (0, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_a_batch_is_judged_like_its_shapes(seed):
    shapes = some_shapes(np.random.default_rng(seed), 400)
    flat = B.Shapes.of(pa.array([None if s is None else [[[{"x": x, "y": y} for x, y in r] for r in p] for p in s] for s in shapes], SHAPE))
    want = [U.shape_problem(*axes(s)) if s else None for s in shapes]
    assert B.problems(flat) == want and len(set(want)) == 6
    sig = B.significance(flat.x, flat.y, flat.ring)
    one = [U.sphere_significance(x, y) for s in shapes if s for px, py in zip(*axes(s)) for x, y in zip(px, py)]
    assert np.allclose(sig, np.concatenate(one), rtol=1e-9, atol=1e-6)
    ladder = [1e5, 500.0, 25.0]
    rungs = [[] if s is None else ladder[: k % 4] for k, s in enumerate(shapes)]
    got = B.first_valid(flat, np.concatenate(one), np.array([t for r in rungs for t in r]), B.counts_to_starts(np.array([len(r) for r in rungs])))
    left = iter(one)
    for s, r, level in zip(shapes, rungs, got, strict=True):
        sig = [[next(left) for _ in p] for p in s or []]
        assert level == next((t for t in r if U.shape_problem(*U.reduced_rings(*axes(s), sig, t)) is None), None)


def test_a_batch_costs_a_fraction_of_its_shapes():
    """Small shapes: what a task does per shape is arithmetic, not numpy calls."""
    import time

    shapes = [s for s in some_shapes(np.random.default_rng(5), 1500) if s and len(s) > 1]
    flat = B.Shapes.of(pa.array([[[[{"x": x, "y": y} for x, y in r] for r in p] for p in s] for s in shapes], SHAPE))
    t = time.perf_counter()
    B.problems(flat), B.significance(flat.x, flat.y, flat.ring)
    batch, t = time.perf_counter() - t, time.perf_counter()
    for s in shapes:
        x, y = axes(s)
        U.shape_problem(x, y), [U.sphere_significance(*r) for p in zip(x, y) for r in zip(*p)]
    assert batch * 3 < time.perf_counter() - t
