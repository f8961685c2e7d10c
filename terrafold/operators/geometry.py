"""Geometry job (G1-G12): WKT in, cleaned, oriented and size-reduced WKT out.

Each row keeps its polygon as a nested array (see ``functions.geo``), so
the shape table is a narrow job. Two things shuffle: the key check (G11), which is a combinable count, and the report of
crossings (G3) inside very large rings, whose edges are dealt over the tiles of a grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.functions.geo import col
from terrafold.functions.geo_rings import crossing_pairs, deal, unwrap
from terrafold.functions.geo_udf import first_valid_rung, shape_crossings, shape_fault, shape_significance
from terrafold.session import scratch, spread

# --- fixed values: the reduction ladder ---------------------------------------
LADDER = (500, 100, 50, 25, 10, 5)   # tolerances in metres, tried in this order
KEEP_PCT = 97.0                      # reduced area must stay strictly above this
UNREDUCED_LEVEL = 1                  # level reported when no tolerance passes
SPLIT_EDGES = 200_000                # rings of more edges are dealt over tiles for the report of crossings
TILE_EDGES = 20_000                  # edges per tile, about
# the order the final table lists its columns in
SHAPE_COLUMNS = ["created_datetime", "geo_type", "neighborhood_type", "id", "name", "fips_code", "state_abbr",
                 "state_fips_code", "county", "county_fips_code", "metro", "incorporated_place", "longitude",
                 "latitude", "geoloc", "geoloc_reduced", "geoloc_reduced_level"]
# -----------------------------------------------------------------------------


def once(df: DataFrame, **cols) -> DataFrame:
    """Add columns evaluated exactly once per row.

    The values come out of a one-row ``inline`` (a Generate), so filters
    on them cannot be pushed below it and projections cannot inline them
    into several consumers -- without this, an expensive nested expression
    is recomputed by every filter and every column that mentions it.
    Values are SQL text or Columns."""
    fields = [(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in cols.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


def vertices_shapes(df: DataFrame, wkt: str = "geoloc", partitions: int | None = None):
    """G1: parse; returns ``(shapes, rejects)``. Rejected rows keep their
    columns plus ``problem``; the rest carry ``shape``. Geometry is CPU
    work per row: ``partitions`` first spreads an input of few splits."""
    parsed = once(spread(df, partitions), shape=geo.parse_wkt(col(wkt)))
    parsed = once(parsed, problem=geo.wkt_problem(col(wkt), "shape"))
    ok = parsed.where(F.col("problem").isNull()).drop("problem")
    rejects = parsed.where(F.col("problem").isNotNull()).drop("shape")
    return ok, rejects


def clean(df: DataFrame, shape: str = "shape") -> DataFrame:
    """G2 + G4 (+ G5 as a by-product): repeated points out, rings closed,
    degenerate rings dropped, rings oriented; ``area_m2`` is the shape's
    spherical area, taken from the per-ring areas cleaning computed anyway.
    A shape can come out with no part (see :func:`shapes`)."""
    rich = once(df.withColumnRenamed(shape, "_raw"), _rich=geo.clean_rich("_raw")).drop("_raw")
    return (rich.withColumn(shape, F.expr(geo.plain("_rich")))
                .withColumn("area_m2", F.expr(geo.rich_area("_rich"))).drop("_rich"))


def vertices(df: DataFrame, keys, shape: str = "shape") -> DataFrame:
    """The vertex table ``(keys.., part, ring, seq, lon, lat)`` (posexplode x3)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    p = df.select(*keys, F.posexplode(shape).alias("part", "_p"))
    r = p.select(*keys, "part", F.posexplode("_p").alias("ring", "_r"))
    v = r.select(*keys, "part", "ring", F.posexplode("_r").alias("seq", "_v"))
    return v.select(*keys, "part", "ring", "seq", F.col("_v.x").alias("lon"), F.col("_v.y").alias("lat"))


def area(df: DataFrame, shape: str = "shape", out: str = "area_m2") -> DataFrame:
    """Shape area in m^2 (already present after :func:`clean`)."""
    return df if out in df.columns else df.withColumn(out, F.expr(geo.shape_area(col(shape))))


def significance(df: DataFrame, shape: str = "shape", out: str = "sig") -> DataFrame:
    """Per-vertex Douglas-Peucker significance, computed once."""
    return once(df, **{out: shape_significance(F.col(shape))})


def _axes(shape: str):
    return F.expr(geo.coords(col(shape), "x")), F.expr(geo.coords(col(shape), "y"))


def reduce(df: DataFrame, ladder=LADDER, keep_pct: float = KEEP_PCT, shape: str = "shape",
           sig: str = "sig") -> DataFrame:
    """First tolerance whose reduced area is strictly above
    ``keep_pct`` percent of the original and whose reduced rings are valid (none crosses itself, all fit together);
    else the original and level 1. A zero original area makes every ratio NULL and falls through. Each
    tolerance costs one filtering pass over the vertices, each one with enough area a check of its rings until one is
    valid; the reduced shape is built once, at the chosen level."""
    df = area(df, shape)
    s, g = col(shape), col(sig)
    if ladder:
        tried = ", ".join(f"CASE WHEN 100D * {geo.reduced_area(s, g, f'{float(t)}D')} / nullif(area_m2, 0D) > {float(keep_pct)}D "
                          f"THEN {float(t)}D END" for t in ladder)
        df = once(df, _tried=f"filter(array({tried}), t_ -> t_ IS NOT NULL)")
        df = once(df, reduced_level=F.coalesce(first_valid_rung(F.col(shape), F.col(sig), F.col("_tried")), F.lit(UNREDUCED_LEVEL))).drop("_tried")
    else:
        df = df.withColumn("reduced_level", F.lit(UNREDUCED_LEVEL))
    reduced = (f"CASE WHEN reduced_level = {UNREDUCED_LEVEL} THEN {s} "
               f"ELSE {geo.reduce_shape(s, g, 'CAST(reduced_level AS DOUBLE)')} END")
    return df.withColumn("reduced", F.expr(reduced))


def crossings(df: DataFrame, keys, shape: str = "shape", split_edges: int = SPLIT_EDGES) -> DataFrame:
    """Crossing edge pairs inside one ring (reported, not repaired).

    A shape whose largest ring has up to ``split_edges`` edges is one row's work. The edges of larger ones are
    dealt to the tiles of a grid they pass, and pairs are met tile by tile, so a huge ring keeps many tasks busy."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    largest = f"coalesce(array_max(transform(flatten({col(shape)}), r_ -> size(r_))), 0)"
    df = df.select(*keys, F.col(shape).alias("_shape"), F.expr(largest).alias("_edges"))
    found = shape_crossings(*_axes("_shape"))
    small = df.where(F.col("_edges") <= split_edges).select(*keys, F.explode(found).alias("_c"))
    small = small.select(*keys, "_c.part", "_c.ring", "_c.seg_i", "_c.seg_j")
    path = scratch(df.sparkSession, "large-rings")
    df.where(F.col("_edges") > split_edges).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    large = df.sparkSession.read.parquet(path)
    if large.isEmpty():
        return small
    tiles = large.select("_row", *[x.alias(n) for x, n in zip(_axes("_shape"), "xy")]).mapInArrow(_tiles, TILE_SCHEMA)
    pairs = tiles.groupBy("row", "part", "ring", "tile_x", "tile_y").applyInArrow(_tile_pairs, "row long, part int, ring int, seg_i int, seg_j int").distinct()
    named = large.select("_row", *keys).join(pairs, F.col("_row") == F.col("row"))
    return small.unionByName(named.select(*keys, "part", "ring", "seg_i", "seg_j"))


TILE_SCHEMA = "row long, part int, ring int, edges long, tile_x long, tile_y long, seg long, ax double, ay double, bx double, by double"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of every ring, once for each tile they pass. A ring around a pole comes as two turns of edges."""
    for b in batches:
        for row, xs, ys in zip(*(b.column(c).to_pylist() for c in ("_row", "x", "y")), strict=True):
            for part, rings in enumerate(zip(xs, ys, strict=True)):
                for ring, (x, y) in enumerate(zip(*rings, strict=True)):
                    x, y = unwrap(x), np.asarray(y, dtype=float)
                    m = len(x) - 1
                    if m < 4:
                        continue
                    turn = 360.0 * round((x[-1] - x[0]) / 360.0)
                    if turn:
                        x, y = np.concatenate([x, x[1:] + turn]), np.concatenate([y, y[1:]])
                    side = max(1, round((m / TILE_EDGES) ** 0.5))
                    width, height = ((float(np.ptp(v)) or 1.0) / side for v in (x, y))
                    edge, tx, ty = deal(x[:-1], y[:-1], x[1:], y[1:], width, height)
                    for k in range(0, len(edge), 1 << 16):
                        e = edge[k : k + (1 << 16)]
                        n = len(e)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, v), t) for v, t in ((row, pa.int64()), (part, pa.int32()), (ring, pa.int32()), (m, pa.int64()))]
                            + [pa.array(v) for v in (tx[k : k + n], ty[k : k + n], e, x[e], y[e], x[e + 1], y[e + 1])],
                            names=["row", "part", "ring", "edges", "tile_x", "tile_y", "seg", "ax", "ay", "bx", "by"])


def _tile_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    row, part, ring = (k.as_py() for k in key[:3])
    m = table.column("edges")[0].as_py()
    seg, ax, ay, bx, by = (table.column(c).to_numpy() for c in ("seg", "ax", "ay", "bx", "by"))

    def adjacent(i, j):
        d = np.abs(seg[i] % m - seg[j] % m)
        return (d <= 1) | (d == m - 1)
    pairs = crossing_pairs(ax, ay, bx, by, adjacent)
    pairs = np.sort(seg[pairs] % m, axis=1).astype(np.int32)
    n = len(pairs)
    return pa.table({"row": pa.array(np.full(n, row), pa.int64()), "part": pa.array(np.full(n, part), pa.int32()), "ring": pa.array(np.full(n, ring), pa.int32()),
                     "seg_i": pa.array(pairs[:, 0], pa.int32()), "seg_j": pa.array(pairs[:, 1], pa.int32())})


OUTCOME = ["_wkt", "_reduced", "_level", "problem"]


def outcomes(df: DataFrame, wkt: str = "geoloc", ladder=LADDER, keep_pct: float = KEEP_PCT, partitions: int | None = None) -> DataFrame:
    """G1-G9 in one pass: every row with its cleaned text ``_wkt``, the reduced text ``_reduced`` and ``_level``, or the reason in
    ``problem`` why it gets none: its text does not parse, it cleans to nothing, a ring properly crosses itself (its area
    cancels, so no level can be told), a hole lies outside its shell or crosses it, or holes or parts overlap. Rings that only
    touch are fine."""
    parsed = once(spread(df, partitions), _raw=geo.parse_wkt(col(wkt)))
    parsed = once(parsed, _text_problem=geo.wkt_problem(col(wkt), "_raw"))
    rich = once(parsed, _rich=geo.clean_rich("CASE WHEN _text_problem IS NULL THEN _raw END")).drop("_raw")
    flat = rich.withColumn("_shape", F.expr(geo.plain("_rich"))).withColumn("area_m2", F.expr(geo.rich_area("_rich"))).drop("_rich")
    # one Python stage for both kernels
    done = once(flat, _sig=shape_significance(F.col("_shape")), _fault=shape_fault(F.col("_shape")))
    problem = F.coalesce("_text_problem", F.when(F.size("_shape") == 0, "empty after cleaning"), "_fault")
    done = done.withColumn("problem", problem).drop("_text_problem", "_fault")
    # an invalid shape has no area to keep, hence no rung
    done = done.withColumn("area_m2", F.when(F.col("problem").isNull(), F.col("area_m2")))
    done = reduce(done, ladder, keep_pct, "_shape", "_sig")
    return done.select(*df.columns, *[F.when(F.col("problem").isNull(), v).alias(n) for n, v in
                                      (("_wkt", F.expr(geo.to_wkt("_shape"))), ("_reduced", F.expr(geo.to_wkt("reduced"))),
                                       ("_level", F.col("reduced_level").cast("int")))], "problem")


def split_outcomes(out: DataFrame, wkt: str = "geoloc", id_col: str = "geo_id", columns=None):
    """The final shape table -- ``geo_id`` renamed ``id``, the cleaned
    ``geoloc``, ``geoloc_reduced`` and ``geoloc_reduced_level`` -- and the rows without a shape, with the problem."""
    given = [c for c in out.columns if c not in OUTCOME]
    cols = columns if columns is not None else [c for c in given if c not in (wkt, id_col)]
    table = out.where(F.col("problem").isNull()).select(
        *[F.col(c) for c in cols if c != id_col], *([F.col(id_col).alias("id")] if id_col in given else []),
        F.col("_wkt").alias(wkt), F.col("_reduced").alias(f"{wkt}_reduced"), F.col("_level").alias(f"{wkt}_reduced_level"))
    return table, out.where(F.col("problem").isNotNull()).select(*given, "problem")


def shapes(df: DataFrame, wkt: str = "geoloc", ladder=LADDER, keep_pct: float = KEEP_PCT,
           id_col: str = "geo_id", columns=None, partitions: int | None = None):
    """G10 without an intermediate table: ``(table, rejects)`` of :func:`split_outcomes`. A caller that writes both
    should write :func:`outcomes` once and split what it wrote."""
    return split_outcomes(outcomes(df, wkt, ladder, keep_pct, partitions), wkt, id_col, columns)


class KeyViolations(RuntimeError):
    """The shape table has duplicate or NULL keys, so nothing was published."""

    def __init__(self, violations: DataFrame, count: int):
        super().__init__(f"{count} keys are duplicate or null; the shape table was not published")
        self.violations = violations


def check_keys(df: DataFrame, keys=("fips_code", "id")) -> None:
    """G11 as a gate: raises :class:`KeyViolations` unless every key is unique and not NULL."""
    found = key_violations(df, keys)
    count = found.count()
    if count:
        raise KeyViolations(found, count)


def key_violations(df: DataFrame, keys=("fips_code", "id")) -> DataFrame:
    """Duplicate or NULL primary-key values; must be empty to publish.
    The duplicate count is a combinable aggregate, so a hot key is reduced
    map-side before the shuffle."""
    keys = list(keys)
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else any_null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(any_null | (F.col("n") > 1)).select(
        *keys, F.when(any_null, F.lit("null key")).otherwise(F.lit("duplicate key")).alias("rule"), "n")


def drop_staging(spark: SparkSession, *names: str) -> None:
    """Drop staging views/tables once the shape table exists."""
    for n in names:
        spark.catalog.dropTempView(n)
        spark.sql(f"DROP TABLE IF EXISTS {n}")
