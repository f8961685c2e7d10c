"""Geometry as nested arrays kept inside the row, as Spark SQL expressions.

A shape is ``array<array<array<struct<x:double,y:double>>>>``: parts, rings
(ring 0 of a part is its shell, the rest are holes), points (x = longitude,
y = latitude, degrees). Keeping a polygon in its own row means parsing,
cleaning, orientation, area and the reduction ladder are narrow JVM
expressions (higher-order functions) -- no explode, no shuffle, no regroup.
Only Douglas-Peucker significance and the validity of rings run in Python,
as Arrow-batched scalar UDFs over whole rows (see ``geo_udf``).

The builders return SQL text (wrap with ``F.expr``): one parse on the JVM
instead of hundreds of Column round trips. Catalyst does not share common
subexpressions inside lambdas, so any argument used twice must be a column
or lambda variable; intermediates are bound once with :func:`let`.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------
EARTH_RADIUS_M = 6371008.8          # mean Earth radius (IUGG), metres
# -----------------------------------------------------------------------------

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
SHAPE = T.ArrayType(T.ArrayType(RING))

# Parsing splits instead of matching repeated groups: Java's regex engine
# recurses once per repetition of a group, which overflows the stack on a
# polygon with a few thousand holes; split() scans iteratively.
BODY_RE = r"(?s)^\s*[A-Za-z]+\s*\((.*)\)\s*$"       # text inside the outermost parentheses
PART_SEP_RE = r"\)\s*\)\s*,\s*\(\s*\("            # between two parts of a multipolygon
PART_ENDS_RE = r"^\s*\(\s*\(|\)\s*\)\s*$"           # outer parentheses of a multipolygon part
RING_ENDS_RE = r"^\s*\(|\)\s*$"                    # outer parentheses of a polygon body
RING_SEP_RE = r"\)\s*,\s*\("                        # between two rings

_ids = itertools.count()
_HALF_R2 = repr(-EARTH_RADIUS_M * EARTH_RADIUS_M / 2.0) + "D"
_SPHERE = 4.0 * math.pi * EARTH_RADIUS_M * EARTH_RADIUS_M


def _v(prefix: str = "v") -> str:
    """A fresh lambda variable name."""
    return f"{prefix}_{next(_ids)}"


def col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def let(value: str, body) -> str:
    """Evaluate ``value`` once, bind it to a variable, return ``body(var)``."""
    v = _v("l")
    return f"get(transform(array({value}), {v} -> {body(v)}), 0)"


def _raw(s: str) -> str:
    return "r'" + s + "'"


def ring_points(r: str) -> str:
    """'x y, x y, ...' -> points, with one split per ring. A ring whose
    number count is not twice its comma count (3-D or broken points) is
    NULL. ``r`` must be a variable or column."""
    i = _v("i")

    def build(ns):
        n_pts = f"(length({r}) - length(replace({r}, ',', '')) + 1)"
        return (f"CASE WHEN size({ns}) = 2 * {n_pts} THEN transform(sequence(0, size({ns}) div 2 - 1), {i} -> "
                f"named_struct('x', try_cast(get({ns}, 2 * {i}) AS DOUBLE), "
                f"'y', try_cast(get({ns}, 2 * {i} + 1) AS DOUBLE))) END")
    return let(f"split(trim({r}), {_raw(r'[\s,]+')})", build)


def parse_wkt(w: str) -> str:
    """G1: POLYGON / MULTIPOLYGON text -> shape (see :func:`wkt_problem`).

    The body inside the outer parentheses is split into parts (multipolygon
    only), each part into rings, each ring into points."""
    p, r = _v("p"), _v("r")

    def parts(body):
        multi = (f"transform(split({body}, {_raw(PART_SEP_RE)}), {p} -> "
                 f"regexp_replace({p}, {_raw(PART_ENDS_RE)}, ''))")
        single = f"array(regexp_replace({body}, {_raw(RING_ENDS_RE)}, ''))"
        return f"CASE WHEN {wkt_kind(w)} = 'MULTIPOLYGON' THEN {multi} ELSE {single} END"

    q = _v("q")
    shape = let(f"regexp_extract({w}, {_raw(BODY_RE)}, 1)", parts)
    return (f"transform({shape}, {q} -> "
            f"transform(split({q}, {_raw(RING_SEP_RE)}), {r} -> {ring_points(r)}))")


def wkt_kind(w: str) -> str:
    return f"upper(regexp_extract({w}, {_raw(r'^\s*([A-Za-z]+)\s*\(')}, 1))"


def wkt_problem(w: str, s: str) -> str:
    """Why a text is rejected, or NULL. Structure is checked by counting:
    the parentheses must be exactly those of the parts and rings found, and
    every point must be two numbers, a longitude within 180 and a latitude
    within 90 degrees; NaN and infinities are not. (A single whole-text regex would
    recurse once per point in Java's engine and overflow on big rings.)"""
    acc, p, p2, r, q = _v("acc"), _v("p"), _v("p"), _v("r"), _v("q")
    kind = wkt_kind(w)
    n_rings = f"aggregate({s}, 0, ({acc}, {p}) -> {acc} + size({p}))"
    n_open = f"(length({w}) - length(replace({w}, '(', '')))"
    n_close = f"(length({w}) - length(replace({w}, ')', '')))"
    bad_point = (f"exists({s}, {p2} -> exists({p2}, {r} -> {r} IS NULL OR "
                 f"exists({r}, {q} -> {q}.x IS NULL OR {q}.y IS NULL "
                 f"OR NOT abs({q}.x) <= 180D OR NOT abs({q}.y) <= 90D)))")  # NaN compares above all numbers

    def body(k):
        expected = f"(CASE WHEN {k} = 'POLYGON' THEN 1 + {n_rings} ELSE 1 + size({s}) + {n_rings} END)"
        return (f"CASE WHEN {w} IS NULL THEN 'null text' "
                f"WHEN {k} NOT IN ('POLYGON', 'MULTIPOLYGON') THEN 'unsupported type' "
                f"WHEN NOT {w} RLIKE {_raw(r'^[\sA-Za-z0-9.,()+\-]*$')} THEN 'unexpected character' "
                f"WHEN size({s}) = 0 THEN 'no polygon' "
                f"WHEN {k} = 'POLYGON' AND size({s}) != 1 THEN 'malformed polygon' "
                f"WHEN {n_open} != {expected} OR {n_close} != {expected} THEN 'unbalanced parentheses' "
                f"WHEN {bad_point} THEN 'bad coordinate' END")
    return let(kind, body)


def ring_signed_area(r: str) -> str:
    """Spherical ring area, m^2, positive when counter-clockwise.

    A = -R^2/2 * sum (lon2 - lon1)(2 + sin lat1 + sin lat2) over the edges
    (Chamberlain & Duquette, JPL Publication 07-03); the longitude step is
    unwrapped into [-180, 180) so a ring crossing the antimeridian takes
    the short way. That sum is what lies between the ring and the south pole.
    Where the steps add up to a whole turn, the ring runs around a pole and parts the sphere in
    two: its area is the smaller side, signed by whether that side lies on the left. ``r`` must be a variable or column."""
    a, b, acc, t = _v("a"), _v("b"), _v("acc"), _v("t")
    m = f"greatest(size({r}) - 1, 0)"
    step = f"(pmod({b}.x - {a}.x + 180D, 360D) - 180D)"
    terms = (f"zip_with(slice({r}, 1, {m}), slice({r}, 2, {m}), ({a}, {b}) -> named_struct('l', {step}, "
             f"'s', radians({step}) * (2D + sin(radians({a}.y)) + sin(radians({b}.y)))))")
    sums = f"aggregate({terms}, named_struct('l', 0D, 's', 0D), ({acc}, {t}) -> named_struct('l', {acc}.l + {t}.l, 's', {acc}.s + {t}.s))"
    # s > 0 runs east, with the north on its left; |s| R^2 / 2 lies south of the ring
    return let(sums, lambda v: f"CASE WHEN abs({v}.l) < 180D THEN {v}.s * {_HALF_R2} WHEN abs({v}.s) * {_HALF_R2} > {-_SPHERE / 2!r}D "
                               f"THEN {v}.s * {_HALF_R2} ELSE sign({v}.s) * ({_SPHERE!r}D + abs({v}.s) * {_HALF_R2}) END")


def clean_ring(r: str) -> str:
    """G2 for one ring: drop consecutive repeated points, close it."""
    p, i = _v("p"), _v("i")
    dedup = f"filter({r}, ({p}, {i}) -> {i} = 0 OR {p} != get({r}, {i} - 1))"
    return let(dedup, lambda d: f"CASE WHEN size({d}) > 0 AND get({d}, 0) != get({d}, size({d}) - 1) "
                                f"THEN concat({d}, array(get({d}, 0))) ELSE {d} END")


def _rich_ring(r: str) -> str:
    """Clean one ring and pair it with its signed area: struct(pts, a)."""
    return let(clean_ring(r), lambda c: f"named_struct('pts', {c}, 'a', {ring_signed_area(c)})")


def _ok(q: str) -> str:
    return f"(size({q}.pts) >= 4 AND {q}.a != 0D)"


def _clean_part(p: str, finish) -> str:
    r, q = _v("r"), _v("q")

    def body(rs):
        kept = f"concat(array(get({rs}, 0)), filter(slice({rs}, 2, greatest(size({rs}) - 1, 1)), {q} -> {_ok(q)}))"
        return f"CASE WHEN {_ok(f'get({rs}, 0)')} THEN {finish(kept)} ELSE filter({rs}, {_v('z')} -> false) END"
    return let(f"transform({p}, {r} -> {_rich_ring(r)})", body)


def clean_rich(s: str) -> str:
    """G2 + G4: repeated points out, rings closed, degenerate rings (under 4
    points or no area) dropped -- a part whose shell goes loses its holes --
    then shells counter-clockwise and holes clockwise (interior on the left,
    the convention of geography types). Rings come back as struct(pts, a)
    with ``a`` positive for shells, negative for holes."""
    p, q, i, p2 = _v("p"), _v("q"), _v("i"), _v("p")

    def orient(kept):
        return (f"transform({kept}, ({q}, {i}) -> CASE WHEN ({i} = 0 AND {q}.a < 0) OR ({i} > 0 AND {q}.a > 0) "
                f"THEN named_struct('pts', reverse({q}.pts), 'a', -{q}.a) ELSE {q} END)")
    return f"filter(transform({s}, {p} -> {_clean_part(p, orient)}), {p2} -> size({p2}) > 0)"


def clean_shape(s: str) -> str:
    """G2 without orientation (points only)."""
    p, q, p2 = _v("p"), _v("q"), _v("p")
    return (f"filter(transform({s}, {p} -> transform({_clean_part(p, lambda kept: kept)}, {q} -> {q}.pts)), "
            f"{p2} -> size({p2}) > 0)")


def plain(rich: str) -> str:
    p, q = _v("p"), _v("q")
    return f"transform({rich}, {p} -> transform({p}, {q} -> {q}.pts))"


def rich_area(rich: str) -> str:
    """G5 from an oriented rich shape: shells minus holes, m^2."""
    acc, q = _v("acc"), _v("q")
    return f"aggregate(flatten({rich}), 0D, ({acc}, {q}) -> {acc} + {q}.a)"


def orient_shape(s: str) -> str:
    """G4 on a plain shape: shells counter-clockwise, holes clockwise."""
    p, r, i = _v("p"), _v("r"), _v("i")
    body = let(ring_signed_area(r), lambda a: f"CASE WHEN ({i} = 0 AND {a} < 0) OR ({i} > 0 AND {a} > 0) "
                                              f"THEN reverse({r}) ELSE {r} END")
    return f"transform({s}, {p} -> transform({p}, ({r}, {i}) -> {body}))"


def orientation(r: str) -> str:
    return let(ring_signed_area(r), lambda a: f"CASE WHEN {a} > 0 THEN 'ccw' WHEN {a} < 0 THEN 'cw' ELSE 'flat' END")


def shape_area(s: str) -> str:
    """|shells| - |holes| in m^2, for any ring orientation."""
    p, r, i, acc, acc2, x = _v("p"), _v("r"), _v("i"), _v("acc"), _v("acc"), _v("x")
    per_ring = f"transform({p}, ({r}, {i}) -> CASE WHEN {i} = 0 THEN abs({ring_signed_area(r)}) ELSE -abs({ring_signed_area(r)}) END)"
    return (f"aggregate(transform({s}, {p} -> aggregate({per_ring}, 0D, ({acc}, {x}) -> {acc} + {x})), 0D, "
            f"({acc2}, {x}) -> {acc2} + {x})")


def coords(s: str, axis: str) -> str:
    """Nested array of one coordinate (x or y) -- the UDF input form."""
    p, r, q = _v("p"), _v("r"), _v("q")
    return f"transform({s}, {p} -> transform({p}, {r} -> transform({r}, {q} -> {q}.{axis})))"


def _keep(r: str, sg: str, t: str) -> str:
    a, b, z, z2 = _v("a"), _v("b"), _v("z"), _v("z")
    return (f"transform(filter(zip_with({r}, {sg}, ({a}, {b}) -> named_struct('p', {a}, 's', {b})), "
            f"{z} -> {z}.s > {t}), {z2} -> {z2}.p)")


def reduced_area(s: str, sig: str, t: str) -> str:
    """Area of the shape reduced at tolerance ``t`` (metres): rings keep the
    vertices with significance above it; a ring left under 4 points counts
    as gone, and a part whose shell is gone counts nothing. Orientation
    survives the reduction, so signed areas add up."""
    p, sp, r, sg, acc, x, acc2, y = _v("p"), _v("sp"), _v("r"), _v("sg"), _v("acc"), _v("x"), _v("acc"), _v("y")
    ring = let(_keep(r, sg, t), lambda k: f"CASE WHEN size({k}) >= 4 THEN {ring_signed_area(k)} ELSE 0D END")
    part = let(f"zip_with({p}, {sp}, ({r}, {sg}) -> {ring})",
               lambda a: f"CASE WHEN get({a}, 0) != 0D THEN aggregate({a}, 0D, ({acc}, {x}) -> {acc} + {x}) ELSE 0D END")
    return f"aggregate(zip_with({s}, {sig}, ({p}, {sp}) -> {part}), 0D, ({acc2}, {y}) -> {acc2} + {y})"


def reduce_shape(s: str, sig: str, t: str) -> str:
    """Keep vertices whose significance exceeds ``t`` (metres). A ring left
    with fewer than 4 points is dropped; a part whose shell is dropped goes
    with its holes."""
    p, sp, r, sg, q, p2 = _v("p"), _v("sp"), _v("r"), _v("sg"), _v("q"), _v("p")
    part = let(f"zip_with({p}, {sp}, ({r}, {sg}) -> {_keep(r, sg, t)})",
               lambda rs: f"CASE WHEN size(get({rs}, 0)) >= 4 THEN filter({rs}, {q} -> size({q}) >= 4) "
                          f"ELSE filter({rs}, {_v('z')} -> false) END")
    return f"filter(zip_with({s}, {sig}, ({p}, {sp}) -> {part}), {p2} -> size({p2}) > 0)"


def _num(v: str) -> str:
    """Plain decimal text for a coordinate: no exponent, no trailing zeros."""
    # decimal(38,15) text always has a point: trim trailing zeros, then the point
    return f"rtrim('.', rtrim('0', CAST(CAST({v} AS DECIMAL(38,15)) AS STRING)))"


def to_wkt(s: str) -> str:
    """Shape -> POLYGON (one part) or MULTIPOLYGON text; NULL if empty."""
    p, r, q = _v("p"), _v("r"), _v("q")
    ring = f"concat('(', array_join(transform({r}, {q} -> concat({_num(q + '.x')}, ' ', {_num(q + '.y')})), ', '), ')')"
    part = f"concat('(', array_join(transform({p}, {r} -> {ring}), ', '), ')')"
    return let(f"transform({s}, {p} -> {part})",
               lambda ps: f"CASE WHEN size({ps}) = 0 THEN CAST(NULL AS STRING) "
                          f"WHEN size({ps}) = 1 THEN concat('POLYGON ', get({ps}, 0)) "
                          f"ELSE concat('MULTIPOLYGON (', array_join({ps}, ', '), ')') END")


def _double_hex(v: str) -> str:
    """The eight bytes of a double, as hex digits, highest byte first: sign, exponent and fraction by exact arithmetic with powers
    of two. Numbers under 2.3e-308 give zero."""
    def bits(a, e):
        fraction = f"CAST(({a} / power(2D, {e}) - 1D) * 4503599627370496D AS BIGINT)"
        return f"lpad(hex(shiftleft(CAST({e} + 1023 AS BIGINT), 52) + {fraction} + CASE WHEN {v} < 0 THEN -9223372036854775808 ELSE 0L END), 16, '0')"

    def exponent(a):
        # log2 may miss by one next to a power of two
        return let(f"CAST(floor(log2({a})) AS INT)", lambda e0: let(
            f"{e0} + CASE WHEN {a} >= power(2D, {e0} + 1) THEN 1 WHEN {a} < power(2D, {e0}) THEN -1 ELSE 0 END", lambda e: bits(a, e)))
    return f"CASE WHEN abs({v}) < 2.2250738585072014E-308D THEN '0000000000000000' ELSE {let(f'abs({v})', exponent)} END"


def to_wkb(s: str) -> str:
    """P5: shape -> well-known binary (big-endian polygon, or multipolygon of several parts); NULL if empty. Expressions only."""
    p, r, q = _v("p"), _v("r"), _v("q")
    count = lambda n: f"lpad(hex(CAST({n} AS BIGINT)), 8, '0')"
    point = f"concat({_double_hex(q + '.x')}, {_double_hex(q + '.y')})"
    ring = f"concat({count(f'size({r})')}, array_join(transform({r}, {q} -> {point}), ''))"
    part = f"concat('0000000003', {count(f'size({p})')}, array_join(transform({p}, {r} -> {ring}), ''))"
    return let(f"transform({s}, {p} -> {part})", lambda ps: f"unhex(CASE WHEN size({ps}) = 1 THEN get({ps}, 0) "
               f"WHEN size({ps}) > 1 THEN concat('0000000006', {count(f'size({ps})')}, array_join({ps}, '')) END)")


def _read_int(b: str, at: str) -> str:
    return f"CAST(conv(hex(substring({b}, CAST({at} AS INT), 4)), 16, 10) AS INT)"


def _read_double(b: str, at: str) -> str:
    def value(h):
        head = f"CAST(conv(substring({h}, 1, 3), 16, 10) AS INT)"
        fraction = f"CAST(conv(substring({h}, 4, 13), 16, 10) AS BIGINT) / 4503599627370496D"
        return (f"CASE WHEN {head} % 2048 = 0 THEN 0D ELSE (1D + {fraction}) * power(2D, {head} % 2048 - 1023) * CASE WHEN {head} >= 2048 THEN -1D ELSE 1D END END")
    return let(f"hex(substring({b}, CAST({at} AS INT), 8))", value)


def from_wkb(b: str) -> str:
    """Well-known binary as :func:`to_wkb` writes it -> shape. ``b`` must be a column or variable."""
    acc, k, acc2, k2, i = _v("acc"), _v("k"), _v("acc"), _v("k"), _v("i")
    ring_type = RING.simpleString()
    empty_part, empty_shape = f"CAST(array() AS array<{ring_type}>)", f"CAST(array() AS {SHAPE.simpleString()})"

    def ring(at, n):
        spot = f"{at} + 4 + 16 * {i}"
        return f"transform(sequence(0, {n} - 1), {i} -> named_struct('x', {_read_double(b, spot)}, 'y', {_read_double(b, f'{spot} + 8')}))"

    def next_ring(a):
        return let(_read_int(b, f"{a}.at"), lambda n: f"named_struct('at', {a}.at + 4 + 16 * {n}, 'rings', concat({a}.rings, array({ring(f'{a}.at', n)})))")
    rings = (f"aggregate(sequence(1, {_read_int(b, f'{acc}.at + 5')}), named_struct('at', {acc}.at + 9, 'rings', {empty_part}), "
             f"({acc2}, {k2}) -> {next_ring(acc2)})")
    part = let(rings, lambda r: f"named_struct('at', {r}.at, 'parts', concat({acc}.parts, array({r}.rings)))")
    multi = f"{_read_int(b, '2')} = 6"
    return (f"CASE WHEN {b} IS NOT NULL THEN aggregate(sequence(1, CASE WHEN {multi} THEN {_read_int(b, '6')} ELSE 1 END), "
            f"named_struct('at', CASE WHEN {multi} THEN 10 ELSE 1 END, 'parts', {empty_shape}), ({acc}, {k}) -> {part}, {acc} -> {acc}.parts) END")
