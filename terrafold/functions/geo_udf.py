"""The per-row geometry kernels that built-in expressions cannot state: Douglas-Peucker significance (G6), ring
crossings (G3), fitting rings (G2) and the first valid rung of the reduction ladder (G7).

All are scalar UDFs over Arrow batches of rows, each row one shape. The functions here work on one shape;
the UDFs call their forms over a whole batch (:mod:`geo_batch`), which fall back on these for large shapes. No
grouping is involved, so there is no shuffle and no group larger than the
row that already holds the polygon.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.functions import geo_batch
from terrafold.functions.geo import EARTH_RADIUS_M
from terrafold.functions.geo_batch import CROSSED
from terrafold.functions.geo_rings import ring_crossings, ring_fault, unwrap

SIG_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
CROSS_TYPE = T.ArrayType(T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("ring", T.IntegerType()),
    T.StructField("seg_i", T.IntegerType()), T.StructField("seg_j", T.IntegerType()),
]))


def seg_dist(px, py, ax, ay, bx, by):
    """Distance from points to the segment a-b (to a, when a == b)."""
    dx, dy = bx - ax, by - ay
    L = dx * dx + dy * dy
    if L == 0.0:
        return np.hypot(px - ax, py - ay)
    t = np.clip(((px - ax) * dx + (py - ay) * dy) / L, 0.0, 1.0)
    return np.hypot(px - (ax + t * dx), py - (ay + t * dy))


def unit_vectors(lon, lat) -> np.ndarray:
    lon, lat = np.radians(np.asarray(lon, dtype=float)), np.radians(np.asarray(lat, dtype=float))
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=-1)


def chord_angle(d: np.ndarray) -> np.ndarray:
    """The angle between two unit vectors, from their difference."""
    return 2.0 * np.arcsin(np.minimum(np.sqrt((d * d).sum(axis=-1)) / 2.0, 1.0))


def arc_dist(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance in metres from points to the great-circle arc a-b: across it where a point lies beside it, else to the
    nearer end. All vectors are taken as differences from an end, so that short arcs keep their precision."""
    da, db = p - a, p - b
    ends = np.minimum(chord_angle(da), chord_angle(db))
    n = np.cross(a, b - a)
    size = np.sqrt((n * n).sum())
    if size == 0.0:
        return EARTH_RADIUS_M * ends
    n = n / size
    beside = (da @ np.cross(n, a) >= 0) & (db @ np.cross(n, b) <= 0)
    return EARTH_RADIUS_M * np.where(beside, np.arcsin(np.minimum(np.abs(da @ n), 1.0)), ends)


def split_significance(n: int, distances) -> np.ndarray:
    """Per-vertex Douglas-Peucker significance: the split distance at which
    the vertex is chosen, capped by its parent's. Douglas-Peucker at
    tolerance t keeps exactly the vertices with significance > t, so one
    pass serves every tolerance. ``distances(lo, hi)`` are those of the vertices
    between two others. Iterative (explicit stack), O(n log n) typical."""
    sig = np.zeros(n)
    if n == 0:
        return sig
    sig[0] = sig[-1] = np.inf
    stack = [(0, n - 1, np.inf)]
    while stack:
        lo, hi, cap = stack.pop()
        if hi - lo < 2:
            continue
        d = distances(lo, hi)
        k = int(np.argmax(d))
        s = min(float(d[k]), cap)
        k += lo + 1
        sig[k] = s
        stack.append((k, hi, s))
        stack.append((lo, k, s))
    return sig


def significance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Significance in the plane."""
    return split_significance(len(x), lambda lo, hi: seg_dist(x[lo + 1:hi], y[lo + 1:hi], x[lo], y[lo], x[hi], y[hi]))


def sphere_significance(lon, lat) -> np.ndarray:
    """Significance on the sphere, in metres: distances to great-circle arcs, exact at any latitude and extent."""
    v = unit_vectors(lon, lat)
    return split_significance(len(v), lambda lo, hi: arc_dist(v[lo + 1:hi], v[lo], v[hi]))


@F.arrow_udf(SIG_TYPE)
def shape_significance(shape: pa.Array) -> pa.Array:
    """Nested significance array, same layout as the shape."""
    s = geo_batch.Shapes.of(shape)
    got = pa.array(geo_batch.significance(s.x, s.y, s.ring))
    for starts in (s.ring, s.part):
        got = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), got)
    return pa.ListArray.from_arrays(pa.array(s.shape, pa.int32()), got, mask=shape.is_null())


@F.pandas_udf(CROSS_TYPE)
def shape_crossings(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Every crossing edge pair inside one ring of the shape."""
    out = []
    for px, py in zip(xs, ys):
        rows = []
        if px is not None:
            for pi, (pxp, pyp) in enumerate(zip(px, py)):
                for ri, (rx, ry) in enumerate(zip(pxp, pyp)):
                    rows += [{"part": pi, "ring": ri, "seg_i": i, "seg_j": j}
                             for i, j in ring_crossings(unwrap(rx), ry)]
        out.append(rows)
    return pd.Series(out)


def shape_problem(px, py) -> str | None:
    """The first thing that makes a cleaned shape invalid: a ring properly crosses itself, or rings do not fit together."""
    if any(ring_crossings(unwrap(rx), ry, proper=True) for pxp, pyp in zip(px, py) for rx, ry in zip(pxp, pyp)):
        return CROSSED
    return ring_fault([[(rx, ry) for rx, ry in zip(pxp, pyp)] for pxp, pyp in zip(px, py)])


@F.arrow_udf(T.StringType())
def shape_fault(shape: pa.Array) -> pa.Array:
    """G2/G3 as a decision: why the shape is invalid, or null."""
    return pa.array(geo_batch.problems(geo_batch.Shapes.of(shape)), pa.string())


def reduced_rings(px, py, sig, tolerance: float):
    """The rings that reduction at a tolerance leaves (see :func:`geo.reduce_shape`)."""
    xs, ys = [], []
    for pxp, pyp, psig in zip(px, py, sig):
        kept = [(np.asarray(rx)[k], np.asarray(ry)[k]) for rx, ry, rs in zip(pxp, pyp, psig) for k in [np.asarray(rs) > tolerance]]
        if kept and len(kept[0][0]) >= 4:
            kept = [r for r in kept if len(r[0]) >= 4]
            xs.append([r[0] for r in kept])
            ys.append([r[1] for r in kept])
    return xs, ys


@F.arrow_udf(T.IntegerType())
def first_valid_rung(shape: pa.Array, sig: pa.Array, rungs: pa.Array) -> pa.Array:
    """The first of a shape's tolerances at which its reduced rings are valid, or null."""
    none = pc.or_(shape.is_null(), sig.is_null())
    tried = geo_batch.counts_to_starts(pc.if_else(none, 0, rungs.value_lengths()).fill_null(0).to_numpy(zero_copy_only=False))
    values = pc.if_else(none, None, rungs).flatten().to_numpy(zero_copy_only=False)
    s = geo_batch.Shapes.of(shape)
    points = sig.flatten().flatten().flatten().to_numpy(zero_copy_only=False)
    return pa.array(geo_batch.first_valid(s, points, values, tried), pa.int32())
