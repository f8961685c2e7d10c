"""Where the edges of rings meet, and whether the rings of a shape fit together.

Edges are dealt to the cells of a grid they pass, and only edges of one cell are compared. Cells are as wide and as
high as the mean edge, so an edge passes about three of them whatever the ring's size.
Everything is numpy over the edges of one shape, or of one tile of a very large ring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Points this close to an edge (degrees, about 0.1 mm) lie on it.
TOUCH = 1e-9
#: Rays are cast for so many (point, edge) pairs at a time.
RAYS = 1 << 21


def unwrap(lon) -> np.ndarray:
    """Longitudes made continuous by whole turns: a ring that does not pass the antimeridian keeps its values."""
    lon = np.asarray(lon, dtype=float)
    return lon - 360.0 * np.cumsum(np.round(np.diff(lon, prepend=lon[:1]) / 360.0))


def grid_size(ax, ay, bx, by) -> tuple[float, float]:
    """Width and height of the cells for these edges."""
    def side(a, b):
        extent = max(a.max(), b.max()) - min(a.min(), b.min())
        return max(float(np.abs(b - a).mean()), extent / 2**28) or 1.0
    return side(ax, bx), side(ay, by)


def deal(ax, ay, bx, by, width: float, height: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells each edge passes: edge, column, row."""
    flip = ax > bx
    x1, y1, x2, y2 = np.where(flip, bx, ax), np.where(flip, by, ay), np.where(flip, ax, bx), np.where(flip, ay, by)
    first, last = np.floor(x1 / width).astype(np.int64), np.floor(x2 / width).astype(np.int64)
    edge, col = _ranges(first, last)
    # the part of the edge inside its column
    ex1, ex2, ey1, ey2 = x1[edge], x2[edge], y1[edge], y2[edge]
    run = np.where(ex2 > ex1, ex2 - ex1, 1.0)
    lo, hi = np.maximum(col * width, ex1), np.minimum((col + 1) * width, ex2)
    ya, yb = ey1 + (lo - ex1) / run * (ey2 - ey1), np.where(ex2 > ex1, ey1 + (hi - ex1) / run * (ey2 - ey1), ey2)
    pad = max(height * 1e-6, 4 * TOUCH)
    low = np.floor((np.minimum(ya, yb) - pad) / height).astype(np.int64)
    high = np.floor((np.maximum(ya, yb) + pad) / height).astype(np.int64)
    part, row = _ranges(low, high)
    return edge[part], col[part], row


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and value of every integer in each range."""
    n = last - first + 1
    at = np.repeat(np.arange(len(n)), n)
    return at, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[at]


def met(ax, ay, bx, by) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of edges that share a cell and whose boxes meet; a pair may come more than once."""
    if len(ax) < 2:
        return
    edge, col, row = deal(ax, ay, bx, by, *grid_size(ax, ay, bx, by))
    order = np.lexsort((edge, row, col))
    edge, col, row = edge[order], col[order], row[order]
    same = np.concatenate([(col[1:] == col[:-1]) & (row[1:] == row[:-1]), [False]])
    # left[k]: edges after k in its cell
    ends = np.flatnonzero(~same)
    left = ends[np.searchsorted(ends, np.arange(len(edge)))] - np.arange(len(edge))
    x1, x2, y1, y2 = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)
    step, open_ = 1, np.flatnonzero(left >= 1)
    while len(open_):
        i, j = edge[open_], edge[open_ + step]
        i, j = np.minimum(i, j), np.maximum(i, j)
        near = (x1[i] <= x2[j]) & (x1[j] <= x2[i]) & (y1[i] <= y2[j]) & (y1[j] <= y2[i]) & (i != j)
        if near.any():
            yield i[near], j[near]
        step += 1
        open_ = open_[left[open_] >= step]


def _side(ax, ay, bx, by, px, py):
    return np.sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def crossing_pairs(ax, ay, bx, by, adjacent, proper: bool = False) -> np.ndarray:
    """Distinct pairs (i, j), i < j, of edges that meet (``proper``: cross inside both; then the first found only).
    ``adjacent`` tells of arrays i, j which pairs share a vertex of the ring: they are no pairs."""
    found = []
    for i, j in met(ax, ay, bx, by):
        keep = ~adjacent(i, j)
        i, j = i[keep], j[keep]
        o1, o2 = (_side(ax[i], ay[i], bx[i], by[i], *p) for p in ((ax[j], ay[j]), (bx[j], by[j])))
        o3, o4 = (_side(ax[j], ay[j], bx[j], by[j], *p) for p in ((ax[i], ay[i]), (bx[i], by[i])))
        hit = (o1 * o2 < 0) & (o3 * o4 < 0) if proper else (o1 * o2 <= 0) & (o3 * o4 <= 0)
        if hit.any():
            found.append(np.stack([i[hit], j[hit]], axis=1))
            if proper:
                return found[0][:1]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def ring_crossings(x, y, proper: bool = False) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of non-adjacent edges of a closed ring that meet.

    ``x`` is continuous (:func:`unwrap`). The ends of a ring around a pole lie a whole turn apart: its edges are taken
    over two turns, so that they meet their neighbours over the seam. Adjacent edges (sharing a vertex, including the last and first) are not pairs.
    ``proper`` asks only whether two edges cross inside both (touching is no crossing) and stops at the first pair."""
    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    m = len(x) - 1
    if m < 4:
        return []
    turn = round((x[-1] - x[0]) / 360.0)
    if turn:
        x, y = np.concatenate([x, x[1:] + 360.0 * turn]), np.concatenate([y, y[1:]])

    def adjacent(i, j):
        d = np.abs(i % m - j % m)
        return (d <= 1) | (d == m - 1)
    pairs = crossing_pairs(x[:-1], y[:-1], x[1:], y[1:], adjacent, proper)
    if turn:
        pairs = np.unique(np.sort(pairs % m, axis=1), axis=0)
    return [tuple(p) for p in pairs.tolist()]


def planar(x, y) -> tuple[np.ndarray, np.ndarray]:
    """A closed ring in the plane of continuous longitudes: a ring around a pole is led to the pole and back over the seam at its
    vertex nearest to that pole, so that nothing of it lies above the seam."""
    x, y = unwrap(x), np.asarray(y, dtype=float)
    turn = 360.0 * round((x[-1] - x[0]) / 360.0) if len(x) else 0.0
    if not turn:
        return x, y
    # the pole whose cap is the smaller side
    step = np.radians(np.diff(x))
    south = abs((step * (2 + np.sin(np.radians(y[:-1])) + np.sin(np.radians(y[1:])))).sum()) / 2
    pole = -90.0 if south < 2 * np.pi else 90.0
    k = int(np.argmax(y * np.sign(pole)))
    x, y = np.concatenate([x[k:-1], x[: k + 1] + turn]), np.concatenate([y[k:-1], y[: k + 1]])
    return np.concatenate([x, [x[-1], x[0], x[0]]]), np.concatenate([y, [pole, pole, y[0]]])


class Edges:
    """The edges of one or more closed rings, with their box."""

    def __init__(self, rings: list[tuple[np.ndarray, np.ndarray]]):
        self.ax, self.bx = (np.concatenate([r[0][s] for r in rings]) for s in (np.s_[:-1], np.s_[1:]))
        self.ay, self.by = (np.concatenate([r[1][s] for r in rings]) for s in (np.s_[:-1], np.s_[1:]))
        self.low = min(self.ax.min(), self.bx.min()), self.ay.min()
        self.high = max(self.ax.max(), self.bx.max()), self.ay.max()

    def turn_to(self, other: Edges) -> float:
        """Whole turns that bring this box next to the other."""
        return 360.0 * np.round(((other.low[0] + other.high[0]) - (self.low[0] + self.high[0])) / 720.0)

    def boxes_meet(self, other: Edges) -> bool:
        t = self.turn_to(other)
        return (self.low[0] + t <= other.high[0] + TOUCH and other.low[0] <= self.high[0] + t + TOUCH
                and self.low[1] <= other.high[1] + TOUCH and other.low[1] <= self.high[1] + TOUCH)

    def inside(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """1 for points inside (an odd number of edges on the ray to the right), -1 outside, 0 on an edge."""
        out = np.empty(len(px), np.int64)
        step = max(1, RAYS // max(1, len(self.ax)))
        for k in range(0, len(px), step):
            x, y = px[k : k + step, None], py[k : k + step, None]
            dx, dy = self.bx - self.ax, self.by - self.ay
            over = (self.ay > y) != (self.by > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                right = over & (x < self.ax + (y - self.ay) / dy * dx)
            sides = np.where(right.sum(axis=1) % 2 == 1, 1, -1)
            size = dx * dx + dy * dy
            t = np.clip(((x - self.ax) * dx + (y - self.ay) * dy) / np.where(size > 0, size, 1), 0, 1)
            on = (np.hypot(x - self.ax - t * dx, y - self.ay - t * dy) <= TOUCH).any(axis=1)
            out[k : k + step] = np.where(on, 0, sides)
        return out


def _touching(a: Edges, b: Edges, turn: float) -> tuple[np.ndarray, np.ndarray]:
    """Where ring ``a``, moved by ``turn``, meets the edges of ``b``: edge of ``a``, and the fraction along it."""
    ax, bx = a.ax + turn, a.bx + turn
    inb = (np.minimum(ax, bx) <= b.high[0] + TOUCH) & (np.maximum(ax, bx) >= b.low[0] - TOUCH) & (np.minimum(a.ay, a.by) <= b.high[1] + TOUCH) & (np.maximum(a.ay, a.by) >= b.low[1] - TOUCH)
    low, high = (a.low[0] + turn, a.low[1]), (a.high[0] + turn, a.high[1])
    ina = (np.minimum(b.ax, b.bx) <= high[0] + TOUCH) & (np.maximum(b.ax, b.bx) >= low[0] - TOUCH) & (np.minimum(b.ay, b.by) <= high[1] + TOUCH) & (np.maximum(b.ay, b.by) >= low[1] - TOUCH)
    ia, n = np.flatnonzero(inb), int(inb.sum())
    sx, sy = np.concatenate([ax[inb], b.ax[ina]]), np.concatenate([a.ay[inb], b.ay[ina]])
    ex, ey = np.concatenate([bx[inb], b.bx[ina]]), np.concatenate([a.by[inb], b.by[ina]])
    # boxes that just touch must share a cell
    grow = 2 * TOUCH
    edges, at = [], []
    wide = lambda s, e: (s - grow * np.sign(e - s + 0.5 * (e == s)), e + grow * np.sign(e - s + 0.5 * (e == s)))
    (gsx, gex), (gsy, gey) = wide(sx, ex), wide(sy, ey)
    for i, j in met(gsx, gsy, gex, gey):
        cross = (i < n) & (j >= n)
        i, j = i[cross], j[cross]
        if not len(i):
            continue
        x1, y1, dx, dy = sx[i], sy[i], ex[i] - sx[i], ey[i] - sy[i]
        x3, y3, fx, fy = sx[j], sy[j], ex[j] - sx[j], ey[j] - sy[j]
        size, det = dx * dx + dy * dy, dx * fy - dy * fx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((x3 - x1) * fy - (y3 - y1) * fx) / det
            u = ((x3 - x1) * dy - (y3 - y1) * dx) / det
            ok = (det != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
            edges.append(ia[i[ok]]), at.append(t[ok])
            # ends of one edge on the other
            for qx, qy in ((x3, y3), (x3 + fx, y3 + fy)):
                s = np.clip(((qx - x1) * dx + (qy - y1) * dy) / size, 0, 1)
                on = np.hypot(x1 + s * dx - qx, y1 + s * dy - qy) <= TOUCH
                edges.append(ia[i[on]]), at.append(s[on])
            other = fx * fx + fy * fy
            for s, qx, qy in ((0.0, x1, y1), (1.0, x1 + dx, y1 + dy)):
                v = np.clip(((qx - x3) * fx + (qy - y3) * fy) / other, 0, 1)
                on = np.hypot(x3 + v * fx - qx, y3 + v * fy - qy) <= TOUCH
                edges.append(ia[i[on]]), at.append(np.full(int(on.sum()), s))
    return (np.concatenate(edges), np.concatenate(at)) if edges else (np.zeros(0, np.int64), np.zeros(0))


def sides(a: Edges, b: Edges) -> set[int]:
    """On which sides of ``b`` (1 inside, -1 outside, 0 along its edges) the ring ``a`` runs.

    Between two points where they meet, a ring stays on one side, so one point of each such stretch tells."""
    turn = a.turn_to(b)
    edge, t = _touching(a, b, turn)
    if not len(edge):
        return {int(b.inside(a.ax[:1] + turn, a.ay[:1])[0])}
    # stretches begin at a meeting point and end at the next one on that edge, or at the edge's end
    order = np.lexsort((t, edge))
    edge, t = edge[order], t[order]
    last = np.concatenate([edge[1:] != edge[:-1], [True]])
    end = np.where(last, 1.0, np.concatenate([t[1:], [1.0]]))
    first = np.concatenate([[True], ~(edge[1:] == edge[:-1])])
    edge, t, end = np.concatenate([edge, edge[first]]), np.concatenate([t, np.zeros(int(first.sum()))]), np.concatenate([end, t[first]])
    length = np.hypot(a.bx[edge] - a.ax[edge], a.by[edge] - a.ay[edge])
    keep = (end - t) * length > 2 * TOUCH
    edge, mid = edge[keep], (t[keep] + end[keep]) / 2
    px, py = a.ax[edge] + mid * (a.bx[edge] - a.ax[edge]) + turn, a.ay[edge] + mid * (a.by[edge] - a.ay[edge])
    got = set(b.inside(px, py).tolist())
    # a ring that only passes vertices of b at the ends of its edges: the next edge begins a stretch, too
    after = np.setdiff1d((edge + 1) % len(a.ax), edge)
    if len(after):
        mx, my = (a.ax[after] + a.bx[after]) / 2 + turn, (a.ay[after] + a.by[after]) / 2
        got |= set(b.inside(mx, my).tolist())
    return got


def _close(boxes: list[Edges]) -> Iterator[tuple[int, int]]:
    """Pairs of boxes that meet, in the order of their lower sides."""
    low, high = np.array([b.low[1] for b in boxes]), np.array([b.high[1] for b in boxes])
    order = np.argsort(low, kind="stable")
    ends = np.searchsorted(low[order], high[order] + TOUCH, side="right")
    for k, i in enumerate(order.tolist()):
        for j in order[k + 1 : ends[k]].tolist():
            if boxes[i].boxes_meet(boxes[j]):
                yield i, j


def _overlap(a: Edges, b: Edges, rings_a: list[Edges], rings_b: list[Edges]) -> bool:
    """Do the insides of two areas (each with its rings) share more than an edge?"""
    there = set().union(*(sides(r, b) for r in rings_a if r.boxes_meet(b)))
    if 1 in there:
        return True
    back = set().union(*(sides(r, a) for r in rings_b if r.boxes_meet(a)))
    return 1 in back or (there == {0} and back == {0})


def ring_fault(parts) -> str | None:
    """Why the rings of a shape do not fit together, or None. ``parts``: a list of parts, each a list of (lon, lat) rings, the shell first.

    A hole must lie inside its shell, holes of a part and the parts themselves must not overlap; touching, along an edge too, is
    allowed. Rings that cross themselves are :func:`ring_crossings`'s matter."""
    areas = []
    for part in parts:
        rings = [planar(x, y) for x, y in part]
        edges = [Edges([r]) for r in rings]
        shell = edges[0]
        for hole in edges[1:]:
            got = sides(hole, shell) if hole.boxes_meet(shell) else {-1}
            if -1 in got or 1 not in got:
                return "hole crosses its shell" if 1 in got else "hole outside its shell"
        for i, j in _close(edges[1:]):
            if _overlap(edges[1 + i], edges[1 + j], [edges[1 + i]], [edges[1 + j]]):
                return "holes overlap"
        # all rings of a part in one turn
        moved = [(x + e.turn_to(shell), y) for (x, y), e in zip(rings, edges, strict=True)]
        areas.append((Edges(moved), edges))
    for i, j in _close([a for a, _ in areas]):
        if _overlap(areas[i][0], areas[j][0], areas[i][1], areas[j][1]):
            return "parts overlap"
    return None
