"""The geometry kernels over all shapes of an Arrow batch at once: significance (G6), ring crossings and fitting rings (G2, G3),
the first valid rung (G7).

Shapes of a few dozen edges cost more in numpy calls than in arithmetic, so their rings lie flat, one behind the other, and each
step is one call for the whole batch. The formulas are those of :mod:`geo_rings` and :mod:`geo_udf`, edge by edge; shapes with
large rings, many rings or a ring around a pole go there one by one."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from terrafold.functions.geo import EARTH_RADIUS_M
from terrafold.functions.geo_rings import TOUCH, ring_crossings, ring_fault, unwrap

CROSSED = "ring crosses itself"
#: Rings of up to so many edges are compared edge by edge; shapes of up to so many rings, pairs of rings of up to so many edge pairs.
EDGES, RINGS, PAIRS = 48, 24, 4096
#: Points, and pairs of edges, that are worked on together.
POINTS, TOGETHER = 1 << 16, 1 << 19


def counts_to_starts(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def ranges(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: the group of every member, and its place in the group."""
    group = np.repeat(np.arange(len(n)), n)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)


@dataclass
class Shapes:
    """Shapes of a batch: coordinates of all points, where each ring's points, each part's rings and each shape's parts begin."""

    x: np.ndarray
    y: np.ndarray
    ring: np.ndarray
    part: np.ndarray
    shape: np.ndarray

    @staticmethod
    def of(col: pa.Array) -> Shapes:
        """From array<array<array<struct<x, y>>>>; a null shape has no part."""
        starts = []
        for _ in range(3):
            starts.append(counts_to_starts(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            col = col.flatten()
        x, y = (c.to_numpy(zero_copy_only=False) for c in col.flatten())
        return Shapes(x, y, starts[2], starts[1], starts[0])

    def part_of_ring(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.part) - 1), np.diff(self.part))

    def shape_of_part(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.shape) - 1), np.diff(self.shape))

    def parts(self, k: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """One shape as :func:`geo_rings.ring_fault` takes it."""
        at = lambda r: slice(self.ring[r], self.ring[r + 1])
        return [[(self.x[at(r)], self.y[at(r)]) for r in range(self.part[p], self.part[p + 1])] for p in range(self.shape[k], self.shape[k + 1])]


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([a[:, 1] * b[:, 2] - a[:, 2] * b[:, 1], a[:, 2] * b[:, 0] - a[:, 0] * b[:, 2], a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]], axis=1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _angle(d: np.ndarray) -> np.ndarray:
    return 2.0 * np.arcsin(np.minimum(np.sqrt(_dot(d, d)) / 2.0, 1.0))


def arc_distances(v: np.ndarray, point: np.ndarray, lo: np.ndarray, hi: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """:func:`geo_udf.arc_dist` of each point to the arc of its segment (``lo``, ``hi``: the segments' ends)."""
    a, b = v[lo], v[hi]
    n = _cross(a, b - a)
    size = np.sqrt(_dot(n, n))
    flat = size == 0.0
    n = n / np.where(flat, 1.0, size)[:, None]
    from_a, from_b = _cross(n, a), _cross(n, b)
    p = v[point]
    da, db = p - a[seg], p - b[seg]
    ends = np.minimum(_angle(da), _angle(db))
    beside = (_dot(da, from_a[seg]) >= 0) & (_dot(db, from_b[seg]) <= 0) & ~flat[seg]
    return EARTH_RADIUS_M * np.where(beside, np.arcsin(np.minimum(np.abs(_dot(da, n[seg])), 1.0)), ends)


def significance(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """:func:`geo_udf.sphere_significance` of every ring: the open segments of all rings are split together, once per round."""
    sig = np.zeros(len(x))
    begin = 0
    while begin < len(ring) - 1:  # rings of POINTS points at a time; a larger ring alone
        end = max(begin + 1, int(np.searchsorted(ring, ring[begin] + POINTS, side="right")) - 1)
        a, b = ring[begin], ring[end]
        sig[a:b] = _significance(x[a:b], y[a:b], ring[begin : end + 1] - a)
        begin = end
    return sig


def _significance(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> np.ndarray:
    sig = np.zeros(len(x))
    lon, lat = np.radians(x), np.radians(y)
    v = np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)
    first, last = ring[:-1], ring[1:] - 1
    some = last >= first
    sig[first[some]] = sig[last[some]] = np.inf
    keep = last - first >= 2
    lo, hi = first[keep], last[keep]
    cap = np.full(len(lo), np.inf)
    while len(lo):
        inner = hi - lo - 1
        seg, place = ranges(inner)
        point = lo[seg] + 1 + place
        d = arc_distances(v, point, lo, hi, seg)
        d[np.isnan(d)] = np.inf
        most = np.maximum.reduceat(d, np.cumsum(inner) - inner)
        hit = np.flatnonzero(d == most[seg])
        s = seg[hit]
        k = point[hit[np.concatenate([[True], s[1:] != s[:-1]])]]
        cap = np.minimum(most, cap)
        sig[k] = cap
        lo, hi, cap = np.concatenate([lo, k]), np.concatenate([k, hi]), np.concatenate([cap, cap])
        keep = hi - lo >= 2
        lo, hi, cap = lo[keep], hi[keep], cap[keep]
    return sig


def _unwrapped(s: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Continuous longitudes (:func:`geo_rings.unwrap`) of every ring, and which rings run around a pole."""
    x = s.x
    n = np.diff(s.ring)
    around = np.zeros(len(n), bool)
    if not len(x):
        return x, around
    step = np.round(np.diff(x, prepend=x[:1]) / 360.0)
    step[s.ring[:-1][n > 0]] = 0
    if step.any():
        x = x.copy()
        for r in np.unique(np.searchsorted(s.ring, np.flatnonzero(step), side="right") - 1).tolist():
            at = slice(s.ring[r], s.ring[r + 1])
            x[at] = unwrap(x[at])
            around[r] = round((x[at][-1] - x[at][0]) / 360.0) != 0
    return x, around


def _crossed(x: np.ndarray, y: np.ndarray, ring: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Which of these rings cross themselves properly (``which``: ring numbers; none runs around a pole)."""
    out = np.zeros(len(ring) - 1, bool)
    m = np.diff(ring)[which] - 1
    for edges in np.unique(m[m >= 4]).tolist():
        rings = which[m == edges]
        if edges > EDGES:
            for r in rings.tolist():
                out[r] = bool(ring_crossings(x[ring[r] : ring[r + 1]], y[ring[r] : ring[r + 1]], proper=True))
            continue
        i, j = np.triu_indices(edges, 2)
        i, j = i[j - i != edges - 1], j[j - i != edges - 1]
        step = max(1, TOGETHER // (4 * len(i)))
        for k in range(0, len(rings), step):
            at = ring[rings[k : k + step]][:, None] + np.arange(edges + 1)
            px, py = x[at], y[at]
            ax, ay, bx, by = px[:, i], py[:, i], px[:, i + 1], py[:, i + 1]
            cx, cy, dx, dy = px[:, j], py[:, j], px[:, j + 1], py[:, j + 1]
            hit = _opposite(ax, ay, bx, by, cx, cy, dx, dy) & _opposite(cx, cy, dx, dy, ax, ay, bx, by)
            out[rings[k : k + step]] = hit.any(axis=1)
    return out


def _opposite(ax, ay, bx, by, px, py, qx, qy) -> np.ndarray:
    """Do p and q lie on different sides of a-b?"""
    p, q = (bx - ax) * (py - ay) - (by - ay) * (px - ax), (bx - ax) * (qy - ay) - (by - ay) * (qx - ax)
    return ((p < 0) & (q > 0)) | ((p > 0) & (q < 0))


class _Questions:
    """On which sides of an area (rings, each moved by whole turns) a ring runs, asked for many at once (:func:`geo_rings.sides`)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ring: np.ndarray):
        self.x, self.y, self.ring, self.edges = x, y, ring, np.diff(ring) - 1
        self.asked: list[tuple[int, float, int]] = []
        self.area_rings: list[int] = []
        self.area_turns: list[float] = []
        self.areas = [0]

    def area(self, rings: list[int], turns: list[float]) -> int:
        self.area_rings += rings
        self.area_turns += turns
        self.areas.append(len(self.area_rings))
        return len(self.areas) - 2

    def ask(self, ring: int, turn: float, area: int) -> int:
        self.asked.append((ring, turn, area))
        return len(self.asked) - 1

    def answers(self) -> np.ndarray:
        """One row per question: inside, outside, along its edges."""
        out = np.zeros((len(self.asked), 3), bool)
        if not self.asked:
            return out
        ring, turn, area = (np.array(v) for v in zip(*self.asked, strict=True))
        area_at, area_rings, area_turns = np.array(self.areas), np.array(self.area_rings), np.array(self.area_turns)
        per_area = np.add.reduceat(self.edges[area_rings], area_at[:-1])
        cost = counts_to_starts(self.edges[ring] * per_area[area])
        begin = 0
        while begin < len(ring):
            end = max(begin + 1, int(np.searchsorted(cost, cost[begin] + TOGETHER, side="right")) - 1)
            some = slice(begin, end)
            of, place = ranges(np.diff(area_at)[area[some]])
            member = area_at[area[some]][of] + place
            a = self._edges(ring[some], turn[some])
            b = self._edges(area_rings[member], area_turns[member])
            out[some] = _sides(a, self.edges[ring[some]], b, per_area[area[some]])
            begin = end
        return out

    def _edges(self, rings: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, ...]:
        of, place = ranges(self.edges[rings])
        at = self.ring[rings][of] + place
        return self.x[at] + turns[of], self.y[at], self.x[at + 1] + turns[of], self.y[at + 1]


def _box(e: tuple[np.ndarray, ...], begin: np.ndarray) -> tuple[np.ndarray, ...]:
    ax, ay, bx, by = e
    low, high = np.minimum.reduceat, np.maximum.reduceat
    return low(np.minimum(ax, bx), begin), low(ay, begin), high(np.maximum(ax, bx), begin), high(ay, begin)


def _sides(a: tuple[np.ndarray, ...], na: np.ndarray, b: tuple[np.ndarray, ...], nb: np.ndarray) -> np.ndarray:
    """Sides of the edge groups ``b`` (sizes ``nb``) on which the closed rings ``a`` (sizes ``na``) run; see :func:`geo_rings.sides`."""
    a_at, b_at = np.cumsum(na) - na, np.cumsum(nb) - nb
    ax, ay, bx, by = a
    a_of, b_of = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)

    def near(e, box, of):  # edges in reach of the other side's box
        return ((np.minimum(e[0], e[2]) <= box[2][of] + TOUCH) & (np.maximum(e[0], e[2]) >= box[0][of] - TOUCH)
                & (np.minimum(e[1], e[3]) <= box[3][of] + TOUCH) & (np.maximum(e[1], e[3]) >= box[1][of] - TOUCH))
    ia, ib = np.flatnonzero(near(a, _box(b, b_at), a_of)), np.flatnonzero(near(b, _box(a, a_at), b_of))
    # every near edge of a with every near edge of its b
    per_b = np.bincount(b_of[ib], minlength=len(nb))
    first_b = np.cumsum(per_b) - per_b
    k, place = ranges(per_b[a_of[ia]])
    i, j = ia[k], ib[(first_b[a_of[ia]][k] + place)] if len(k) else k
    grow = 4 * TOUCH
    meet = ((np.minimum(ax, bx)[i] <= np.maximum(b[0], b[2])[j] + grow) & (np.minimum(b[0], b[2])[j] <= np.maximum(ax, bx)[i] + grow)
            & (np.minimum(ay, by)[i] <= np.maximum(b[1], b[3])[j] + grow) & (np.minimum(b[1], b[3])[j] <= np.maximum(ay, by)[i] + grow))
    edge, t = _touching(a, b, i[meet], j[meet])
    # stretches begin at a meeting point and end at the next one on that edge, or at the edge's end
    order = np.lexsort((t, edge))
    edge, t = edge[order], t[order]
    if len(edge):
        last = np.concatenate([edge[1:] != edge[:-1], [True]])
        end = np.where(last, 1.0, np.concatenate([t[1:], [1.0]]))
        first = np.concatenate([[True], edge[1:] != edge[:-1]])
        met = np.unique(a_of[edge])
        edge, t, end = np.concatenate([edge, edge[first]]), np.concatenate([t, np.zeros(int(first.sum()))]), np.concatenate([end, t[first]])
        keep = (end - t) * np.hypot(bx[edge] - ax[edge], by[edge] - ay[edge]) > 2 * TOUCH
        edge, mid = edge[keep], (t[keep] + end[keep]) / 2
    else:
        met, mid = edge, t
    # a ring that only passes vertices of b at the ends of its edges: the next edge begins a stretch, too
    own = a_of[edge]
    after = np.setdiff1d(a_at[own] + (edge - a_at[own] + 1) % na[own], edge)
    alone = a_at[np.setdiff1d(np.arange(len(na)), met)]  # one point of a ring that meets nothing
    px = np.concatenate([ax[edge] + mid * (bx[edge] - ax[edge]), (ax[after] + bx[after]) / 2, ax[alone]])
    py = np.concatenate([ay[edge] + mid * (by[edge] - ay[edge]), (ay[after] + by[after]) / 2, ay[alone]])
    of = np.concatenate([own, a_of[after], a_of[alone]])
    side = _inside(px, py, of, b, b_at, nb)
    out = np.zeros((len(na), 3), bool)
    for c, value in enumerate((1, -1, 0)):
        out[of[side == value], c] = True
    return out


def _touching(a, b, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where edges ``i`` of a meet edges ``j`` of b: the edge of a, and the fraction along it (see :func:`geo_rings._touching`)."""
    x1, y1, x3, y3 = a[0][i], a[1][i], b[0][j], b[1][j]
    dx, dy, fx, fy = a[2][i] - x1, a[3][i] - y1, b[2][j] - x3, b[3][j] - y3
    size, other, det = dx * dx + dy * dy, fx * fx + fy * fy, dx * fy - dy * fx
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((x3 - x1) * fy - (y3 - y1) * fx) / det
        u = ((x3 - x1) * dy - (y3 - y1) * dx) / det
        ok = (det != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        edges, at = [i[ok]], [t[ok]]
        # ends of one edge on the other
        for qx, qy in ((x3, y3), (x3 + fx, y3 + fy)):
            s = np.clip(((qx - x1) * dx + (qy - y1) * dy) / size, 0, 1)
            on = np.hypot(x1 + s * dx - qx, y1 + s * dy - qy) <= TOUCH
            edges.append(i[on]), at.append(s[on])
        for s, qx, qy in ((0.0, x1, y1), (1.0, x1 + dx, y1 + dy)):
            v = np.clip(((qx - x3) * fx + (qy - y3) * fy) / other, 0, 1)
            on = np.hypot(x3 + v * fx - qx, y3 + v * fy - qy) <= TOUCH
            edges.append(i[on]), at.append(np.full(int(on.sum()), s))
    return np.concatenate(edges), np.concatenate(at)


def _inside(px: np.ndarray, py: np.ndarray, of: np.ndarray, b, b_at: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """:meth:`geo_rings.Edges.inside` of each point for the edges of its group."""
    out = np.empty(len(px), np.int64)
    cost = counts_to_starts(nb[of])
    begin = 0
    while begin < len(px):
        end = max(begin + 1, int(np.searchsorted(cost, cost[begin] + TOGETHER, side="right")) - 1)
        q = of[begin:end]
        k, place = ranges(nb[q])
        e = b_at[q][k] + place
        ax, ay, bx, by = (v[e] for v in b)
        x, y = px[begin:end][k], py[begin:end][k]
        dx, dy = bx - ax, by - ay
        over = (ay > y) != (by > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            right = over & (x < ax + (y - ay) / dy * dx)
        size = dx * dx + dy * dy
        t = np.clip(((x - ax) * dx + (y - ay) * dy) / np.where(size > 0, size, 1), 0, 1)
        on = np.hypot(x - ax - t * dx, y - ay - t * dy) <= TOUCH
        starts = cost[begin:end] - cost[begin]
        odd = np.add.reduceat(right.astype(np.int64), starts) % 2 == 1
        out[begin:end] = np.where(np.logical_or.reduceat(on, starts), 0, np.where(odd, 1, -1))
        begin = end
    return out


def problems(s: Shapes) -> list[str | None]:
    """:func:`geo_udf.shape_problem` of every shape."""
    out: list[str | None] = [None] * (len(s.shape) - 1)
    if not len(s.ring) - 1:
        return out
    x, around = _unwrapped(s)
    part_of_ring, shape_of_part = s.part_of_ring(), s.shape_of_part()
    shape_of_ring = shape_of_part[part_of_ring]
    crossed = _crossed(x, s.y, s.ring, np.flatnonzero(~around))
    for r in np.flatnonzero(around).tolist():
        at = slice(s.ring[r], s.ring[r + 1])
        crossed[r] = bool(ring_crossings(x[at], s.y[at], proper=True))
    bad = np.zeros(len(out), bool)
    bad[shape_of_ring[crossed]] = True
    for k in np.flatnonzero(bad).tolist():
        out[k] = CROSSED
    rings = np.bincount(shape_of_ring, minlength=len(out))
    edges = np.diff(s.ring) - 1
    all_edges = np.bincount(shape_of_ring, weights=edges, minlength=len(out))
    large = np.zeros(len(out), bool)
    large[shape_of_ring[around | (edges < 1)]] = True
    most = np.zeros(len(out))
    np.maximum.at(most, shape_of_ring, edges)
    large |= (rings > RINGS) | (most * all_edges > PAIRS)
    many = (rings > 1) & ~bad
    for k in np.flatnonzero(many & large).tolist():
        out[k] = ring_fault(s.parts(k))
    _faults(out, s, x, np.flatnonzero(many & ~large))
    return out


def _faults(out: list[str | None], s: Shapes, x: np.ndarray, which: np.ndarray) -> None:
    """:func:`geo_rings.ring_fault` of these shapes, into ``out``."""
    if not len(which):
        return
    begin = s.ring[:-1]
    low, high = np.minimum.reduceat, np.maximum.reduceat
    boxes = [v.tolist() for v in (low(x, begin), low(s.y, begin), high(x, begin), high(s.y, begin))]
    x1, y1, x2, y2 = boxes
    part, shape = s.part.tolist(), s.shape.tolist()
    ask = _Questions(x, s.y, s.ring)

    def turn(a, b):  # whole turns that bring box a next to box b
        v = ((b[0] + b[2]) - (a[0] + a[2])) / 720.0
        return 360.0 * round(v) if v > 0.5 or v < -0.5 else 0.0

    def meet(a, b):
        t = turn(a, b)
        return a[0] + t <= b[2] + TOUCH and b[0] <= a[2] + t + TOUCH and a[1] <= b[3] + TOUCH and b[1] <= a[3] + TOUCH

    checks = []
    for k in which.tolist():
        own: list[tuple] = []
        areas = []
        for p in range(shape[k], shape[k + 1]):
            rings = list(range(part[p], part[p + 1]))
            box = [(x1[r], y1[r], x2[r], y2[r]) for r in rings]
            single = [ask.area([r], [0.0]) for r in rings] if len(rings) > 1 else []
            for h in range(1, len(rings)):
                q = ask.ask(rings[h], turn(box[h], box[0]), single[0]) if meet(box[h], box[0]) else -1
                own.append(("hole", q, None))
            for i, j in _close(box, 1, meet):
                own.append(("holes overlap", [ask.ask(rings[i], turn(box[i], box[j]), single[j])], [ask.ask(rings[j], turn(box[j], box[i]), single[i])]))
            turns = [turn(b, box[0]) for b in box]
            whole = (min(b[0] + t for b, t in zip(box, turns)), min(b[1] for b in box), max(b[2] + t for b, t in zip(box, turns)), max(b[3] for b in box))
            areas.append((whole, rings, box, turns))
        if len(areas) > 1:
            for i, j in _close([a[0] for a in areas], 0, meet):
                own.append(("parts overlap", *(_crossing(ask, areas[u], areas[v], turn, meet) for u, v in ((i, j), (j, i)))))
        checks.append((k, own))
    answers = ask.answers().tolist()
    for k, own in checks:
        for name, there, back in own:
            if name == "hole":
                inside, outside, _ = answers[there] if there >= 0 else (False, True, False)
                if outside or not inside:
                    out[k] = "hole crosses its shell" if inside else "hole outside its shell"
                    break
            else:
                a, b = ([any(v) for v in zip(*(answers[q] for q in side))] or [False] * 3 for side in (there, back))
                if a[0] or b[0] or (a == b == [False, False, True]):
                    out[k] = name
                    break


def _crossing(ask: _Questions, a, b, turn, meet) -> list[int]:
    """The questions on which sides of area ``b`` the rings of ``a`` run."""
    whole, rings, _, turns = b
    asked = [(r, turn(box, whole)) for r, box in zip(a[1], a[2]) if meet(box, whole)]
    if not asked:
        return []
    area = ask.area(rings, turns)
    return [ask.ask(r, t, area) for r, t in asked]


def _close(boxes: list[tuple], skip: int, meet) -> list[tuple[int, int]]:
    """Pairs of boxes that meet, in the order of their lower sides (:func:`geo_rings._close`)."""
    order = sorted(range(skip, len(boxes)), key=lambda i: boxes[i][1])
    return [(i, j) for n, i in enumerate(order) for j in order[n + 1 :] if meet(boxes[i], boxes[j])]


def reduced(s: Shapes, sig: np.ndarray, tolerance: np.ndarray, which: np.ndarray) -> Shapes:
    """The shapes ``which`` reduced at a tolerance each (see :func:`geo_udf.reduced_rings`)."""
    limit = np.full(len(s.shape) - 1, np.inf)
    limit[which] = tolerance
    shape_of_part, part_of_ring = s.shape_of_part(), s.part_of_ring()
    chosen = np.zeros(len(s.shape) - 1, bool)
    chosen[which] = True
    ring_of_point = np.repeat(np.arange(len(s.ring) - 1), np.diff(s.ring))
    shape_of_ring = shape_of_part[part_of_ring]
    keep = (sig > limit[shape_of_ring][ring_of_point]) & chosen[shape_of_ring][ring_of_point]
    size = np.bincount(ring_of_point[keep], minlength=len(s.ring) - 1)
    has = np.diff(s.part) > 0
    good_part = np.zeros(len(s.part) - 1, bool)
    good_part[has] = size[s.part[:-1][has]] >= 4
    good_ring = (size >= 4) & good_part[part_of_ring]
    keep &= good_ring[ring_of_point]
    per_part = np.bincount(part_of_ring[good_ring], minlength=len(s.part) - 1)
    per_shape = np.bincount(shape_of_part[good_part], minlength=len(s.shape) - 1)
    return Shapes(s.x[keep], s.y[keep], counts_to_starts(size[good_ring]), counts_to_starts(per_part[good_part]), counts_to_starts(per_shape[which]))


def first_valid(s: Shapes, sig: np.ndarray, tried: np.ndarray, starts: np.ndarray) -> list[int | None]:
    """The first of each shape's tolerances (``tried`` from ``starts``) at which its reduced rings are valid, or None."""
    out: list[int | None] = [None] * (len(s.shape) - 1)
    n = np.diff(starts)
    left, rung = np.arange(len(out)), 0
    while len(left := left[n[left] > rung]):
        at = tried[starts[left] + rung]
        found = np.array([p is None for p in problems(reduced(s, sig, at, left))])
        for k, t in zip(left[found].tolist(), at[found].tolist()):
            out[k] = int(t)
        left, rung = left[~found], rung + 1
    return out
