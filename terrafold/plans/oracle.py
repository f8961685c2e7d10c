"""DuckDB oracle SQL, one statement per registered query.

Written against the supplied tables only; each repeats the input derivation
of ``derive`` in DuckDB's dialect and states the expected operator result
directly (no Spark involved)."""

from __future__ import annotations

from terrafold.plans import derive
from terrafold.plans.derive import BOUNDARY_FIELDS_SQL, HEADER_LINE, MEMBER_SQL, SHAPE_KINDS
from terrafold.plans.registry import LANDING_ROW_SQL, PART_CODES

TAB = "chr(9)"

CUST = f"SELECT *, {MEMBER_SQL} AS member FROM customer"
GOOD = f"SELECT * FROM ({CUST}) c WHERE c_acctbal >= 0 AND c_nationkey <> 24"
RAW_GEOLOC = BOUNDARY_FIELDS_SQL[10]
LON = "CAST(CAST(c_acctbal / 100 AS DECIMAL(12,4)) AS DOUBLE)"

STAGE_COLS = f"""
  member AS geo_type, member AS neighborhood_type,
  CAST(c_custkey AS VARCHAR) AS geo_id,
  CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END AS name,
  substr(c_mktsegment, 1, 2) AS state_abbr,
  CAST(c_nationkey AS VARCHAR) AS state_fips_code,
  c_mktsegment AS metro,
  CASE WHEN c_acctbal > 5000 THEN 'Place ' || CAST(c_nationkey AS VARCHAR) END AS incorporated_place,
  'County ' || CAST(c_nationkey AS VARCHAR) AS county,
  CAST(c_custkey AS VARCHAR) AS county_fips_code,
  {LON} AS longitude,
  CAST(c_nationkey AS DOUBLE) + 0.5 AS latitude,
  {RAW_GEOLOC} AS geoloc"""


def _levels(col: str, labels) -> str:
    whens = " ".join(f"WHEN {col} LIKE 'neighborhoods-{code}%' THEN '{lab}'" for (_, code), lab in zip(derive.SEGMENT_CODES, labels))
    return f"CASE {whens} END"


GEO_TYPE = _levels("member", ["neighborhood_lev_m", "neighborhood_lev_n", "neighborhood_lev_b", "neighborhood_lev_s"])
NB_TYPE = _levels("member", [f"Neighborhood Level {i}" for i in range(1, 5)])

CURATED = f"""SELECT
  {GEO_TYPE} AS geo_type, {NB_TYPE} AS neighborhood_type,
  CAST(c_custkey AS VARCHAR) AS geo_id,
  CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END AS name,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 3, '0') AS fips_code,
  substr(c_mktsegment, 1, 2) AS state_abbr,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_fips_code,
  c_mktsegment AS metro,
  CASE WHEN c_acctbal > 5000 THEN 'Place ' || CAST(c_nationkey AS VARCHAR) END AS incorporated_place,
  'County ' || CAST(c_nationkey AS VARCHAR) AS county,
  lpad(CAST(c_custkey AS VARCHAR), 3, '0') AS county_fips_code,
  CASE WHEN CAST(c_acctbal / 100 AS DECIMAL(12,4)) = 0 THEN NULL ELSE {LON} END AS longitude,
  CAST(c_nationkey AS DOUBLE) + 0.5 AS latitude,
  replace({RAW_GEOLOC}, 'SRID=4326;', '') AS geoloc,
  c_nationkey
FROM ({GOOD}) g"""

CURATED_COLS = ("geo_type, neighborhood_type, geo_id, name, fips_code, state_abbr, state_fips_code, metro, "
                "incorporated_place, county, county_fips_code, longitude, latitude, geoloc")

# rows meeting the landing contract (the only failures in this data are
# the unmapped file prefix)
PUBLISHABLE = f"""SELECT {CURATED_COLS} FROM ({CURATED}) k
WHERE geo_type IS NOT NULL AND neighborhood_type IS NOT NULL AND geo_id IS NOT NULL
  AND length(geo_type) <= 18 AND length(neighborhood_type) <= 20 AND length(geo_id) <= 32
  AND coalesce(length(name), 0) <= 200 AND coalesce(length(fips_code), 0) <= 5
  AND coalesce(length(state_abbr), 0) <= 2 AND coalesce(length(state_fips_code), 0) <= 2
  AND coalesce(length(metro), 0) <= 200 AND coalesce(length(incorporated_place), 0) <= 200
  AND coalesce(length(county), 0) <= 100 AND coalesce(length(county_fips_code), 0) <= 3"""


def _bad_line() -> str:
    full = f"concat_ws({TAB}, " + ", ".join(BOUNDARY_FIELDS_SQL) + ")"
    short = f"concat_ws({TAB}, " + ", ".join(BOUNDARY_FIELDS_SQL[:5]) + ")"
    return f"CASE WHEN c_nationkey = 24 THEN {short} ELSE {full} END"


HEADER = HEADER_LINE.replace("\t", "' || chr(9) || '")

ORDER_DAY = "strftime(o_orderdate, '%Y%m%d')"
ITEMS = f"""SELECT filename,
  CASE WHEN filename LIKE '%community-info%' THEN 'community_info'
       WHEN filename LIKE '%neighborhoods%' THEN 'neighborhoods' ELSE '' END AS product,
  split_part(filename, '-', 1) AS file_date
FROM (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'pending' ELSE {ORDER_DAY} END || '-' ||
        CASE o_orderstatus WHEN 'F' THEN 'neighborhoods-1m' WHEN 'O' THEN 'community-info'
             WHEN 'P' THEN 'neighborhoods-community-info' ELSE 'other' END
        || '-' || CAST(o_orderkey AS VARCHAR) || '.zip' AS filename FROM orders) o"""
WATERMARKS = f"""SELECT p.product, coalesce(max(l.name), '00000000') AS last_date
FROM (VALUES ('neighborhoods'), ('community_info')) p(product)
LEFT JOIN (
  SELECT 'neighborhoods' AS product, {ORDER_DAY} AS name FROM orders
   WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT 'community_info', {ORDER_DAY} FROM orders
   WHERE o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1997-01-01'
) l ON l.product = p.product
GROUP BY p.product"""
INVENTORY = f"""SELECT i.filename, i.product, i.file_date, '20010801' AS upload_date,
  coalesce(w.last_date, '00000000') AS last_date,
  TRY_CAST(i.file_date AS INTEGER) IS NOT NULL AS prefix_ok,
  TRY_CAST(i.file_date AS INTEGER) > CAST(coalesce(w.last_date, '00000000') AS INTEGER) AS is_new
FROM ({ITEMS}) i LEFT JOIN ({WATERMARKS}) w ON i.product = w.product"""


def _wide_sql() -> str:
    typed, sums, names = [], [], []
    for j, t in enumerate(derive.wide_types(), start=1):
        n = f"c{j:03d}"
        names.append(n)
        typed.append(f"CAST(nullif({derive.wide_value_sql(j, t)}, '') AS {'VARCHAR' if t == 'string' else t}) AS {n}")
        v = f"length({n})" if t == "string" else n
        sums.append(f"CAST(CAST(sum({v}) AS DECIMAL(38,4)) AS VARCHAR) AS {n}")
    name_list = ", ".join(f"'{n}'" for n in names)
    return (f"WITH w AS (SELECT {', '.join(typed)} FROM customer WHERE NOT {derive.WIDE_BAD_SQL}), "
            f"s AS (SELECT {', '.join(sums)} FROM w) "
            f"SELECT unnest([{name_list}]) AS column_name, unnest([{', '.join(names)}]) AS total FROM s")


WIDE_LINE = (f"CASE WHEN c_nationkey = 24 THEN {derive.wide_line_sql(5, TAB)} ELSE {derive.wide_line_sql(tab=TAB)} END")

# Expected vertex tables of the five shape kinds after cleaning and
# orientation: (kind, part, ring, seq, dx, dy), offsets in hundredths.
SQ = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
EXPECTED_RINGS = {
    0: [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]],
    1: [[SQ]],
    2: [[SQ], [[(x + 3, y) for x, y in SQ]]],
    3: [[[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]],
    4: [[[(0, 0), (2, 1), (2, 0), (0, 2), (0, 0)]]],
}
assert set(EXPECTED_RINGS) == set(SHAPE_KINDS)
TEMPLATE = "(VALUES " + ", ".join(
    f"({k}, {p}, {r}, {s}, {dx}, {dy})"
    for k, parts in EXPECTED_RINGS.items() for p, rings in enumerate(parts)
    for r, ring in enumerate(rings) for s, (dx, dy) in enumerate(ring)) + ") t(kind, part, ring, seq, dx, dy)"
PARTS = "SELECT p_partkey, p_partkey % 300 - 150 AS gx, p_partkey % 120 - 60 AS gy, p_partkey % 5 AS kind FROM part"
VERTS = f"""SELECT p.p_partkey, t.part, t.ring, t.seq,
  (p.gx * 100 + t.dx) / 100.0 AS lon, (p.gy * 100 + t.dy) / 100.0 AS lat
FROM ({PARTS}) p JOIN {TEMPLATE} ON p.kind = t.kind"""
# (kind, part, ring, orientation as parsed, after orientation)
ORIENT = ("(VALUES (0, 0, 0, 'ccw', 'ccw'), (0, 0, 1, 'cw', 'cw'), (1, 0, 0, 'cw', 'ccw'), (2, 0, 0, 'ccw', 'ccw'), "
          "(2, 1, 0, 'ccw', 'ccw'), (3, 0, 0, 'ccw', 'ccw'), (4, 0, 0, 'ccw', 'ccw')) t(kind, part, ring, b, a)")
# the first tolerance that keeps enough of a spiked square, and the points left there
SPIKE_LEVEL = ("CASE p_partkey % 7 WHEN 0 THEN 500 WHEN 1 THEN 100 WHEN 2 THEN 50 WHEN 3 THEN 25 WHEN 4 THEN 5 "
               "WHEN 6 THEN 10 ELSE 1 END")
SPIKE_POINTS = "CASE WHEN p_partkey % 7 = 0 THEN 5 ELSE 6 END"
R = 6371008.8
AREA = f"""WITH v AS ({VERTS}),
e AS (SELECT p_partkey, part, ring, lon, lat,
        lead(lon) OVER w AS lon2, lead(lat) OVER w AS lat2
      FROM v WINDOW w AS (PARTITION BY p_partkey, part, ring ORDER BY seq)),
r AS (SELECT p_partkey, part, ring,
        sum(radians((((lon2 - lon + 180) % 360) + 360) % 360 - 180) * (2 + sin(radians(lat)) + sin(radians(lat2))))
          * {-R * R / 2!r} AS a
      FROM e WHERE lon2 IS NOT NULL GROUP BY p_partkey, part, ring)
SELECT p_partkey, round(sum(CASE WHEN ring = 0 THEN abs(a) ELSE -abs(a) END), 1) AS area_m2
FROM r GROUP BY p_partkey"""

# the eight bytes of a double, as in IEEE 754: sign, exponent, fraction
_BITS = ("CASE WHEN {v} = 0 THEN repeat('0', 16) ELSE printf('%03x%013x', CAST(floor(log2(abs({v}))) AS BIGINT) + 1023 + CASE WHEN {v} < 0 THEN 2048 ELSE 0 END, "
         "CAST((abs({v}) / pow(2.0, floor(log2(abs({v})))) - 1) * 4503599627370496 AS BIGINT)) END")
WKB = f"""WITH v AS ({VERTS}),
r AS (SELECT p_partkey, part, ring, printf('%08x', count(*)) || string_agg({_BITS.format(v='CAST(lon AS DOUBLE)')} || {_BITS.format(v='CAST(lat AS DOUBLE)')}, '' ORDER BY seq) AS h FROM v GROUP BY ALL),
p AS (SELECT p_partkey, part, '0000000003' || printf('%08x', count(*)) || string_agg(h, '' ORDER BY ring) AS h FROM r GROUP BY ALL),
s AS (SELECT p_partkey, CASE WHEN count(*) = 1 THEN string_agg(h, '') ELSE '0000000006' || printf('%08x', count(*)) || string_agg(h, '' ORDER BY part) END AS h FROM p GROUP BY ALL)
SELECT p_partkey, upper(h) AS wkb, true AS same FROM s"""

# unit vectors of a corner at (longitude, latitude)
_VECTOR = "[cos(radians({y})) * cos(radians({x})), cos(radians({y})) * sin(radians({x})), sin(radians({y}))]::DOUBLE[3]"
_LAT, _RISE = derive.TALL
_LAT2 = f"(CASE WHEN {_LAT} > 0 THEN ({_LAT}) - ({_RISE}) ELSE ({_LAT}) + ({_RISE}) END)"
GREAT_CIRCLE = f"""WITH v AS (SELECT p_partkey, {_VECTOR.format(x='p_partkey % 90', y=_LAT)} AS a, {_VECTOR.format(x='p_partkey % 90 + 20', y=_LAT)} AS p,
                 {_VECTOR.format(x='p_partkey % 90 + 50', y=_LAT2)} AS q FROM part),
n AS (SELECT *, array_cross_product(a, q) AS n FROM v),
d AS (SELECT p_partkey, {2 * R!r} * asin(array_distance(a, q) / 2) AS aq, {R!r} * CASE
        WHEN array_inner_product(array_cross_product(n, a), p) >= 0 AND array_inner_product(array_cross_product(n, q), p) <= 0
        THEN asin(abs(array_inner_product(n, p)) / sqrt(array_inner_product(n, n)))
        ELSE 2 * asin(least(array_distance(a, p), array_distance(q, p)) / 2) END AS across FROM n)
SELECT p_partkey, 1 AS seq, round(least(aq, across)) AS sig_m FROM d UNION ALL SELECT p_partkey, 2, round(aq) FROM d"""

LARGE_RINGS = f"""WITH c AS (SELECT p_brand, p_partkey // {derive.RING_CORNERS} AS block, p_partkey * 37 % 7 AS d, p_partkey * 53 % 11 AS y,
       row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY p_brand, p_partkey // {derive.RING_CORNERS}) AS n
       FROM part WINDOW w AS (PARTITION BY p_brand, p_partkey // {derive.RING_CORNERS} ORDER BY p_partkey)),
pt AS (SELECT p_brand, block, i, (2 * i + d) / 64::DOUBLE AS x, y / 64::DOUBLE AS y FROM c
       UNION ALL SELECT p_brand, block, n, (2 * n + 9) / 64::DOUBLE, -1 FROM c WHERE i = 0 UNION ALL SELECT p_brand, block, n + 1, -1, -1 FROM c WHERE i = 0
       UNION ALL SELECT p_brand, block, n + 2, d / 64::DOUBLE, y / 64::DOUBLE FROM c WHERE i = 0),
e AS (SELECT p_brand, block, i, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS cy, max(i) OVER (PARTITION BY p_brand, block) AS m
      FROM pt WINDOW w AS (PARTITION BY p_brand, block ORDER BY i))
SELECT s.p_brand, s.block, 0 AS part, 0 AS ring, s.i AS seg_i, t.i AS seg_j FROM e s JOIN e t ON s.p_brand = t.p_brand AND s.block = t.block
 AND t.i > s.i + 1 AND NOT (s.i = 0 AND t.i = s.m - 1) AND least(s.ax, s.bx) <= greatest(t.ax, t.bx) AND least(t.ax, t.bx) <= greatest(s.ax, s.bx)
 AND least(s.ay, s.cy) <= greatest(t.ay, t.cy) AND least(t.ay, t.cy) <= greatest(s.ay, s.cy)
 AND sign((s.bx - s.ax) * (t.ay - s.ay) - (s.cy - s.ay) * (t.ax - s.ax)) * sign((s.bx - s.ax) * (t.cy - s.ay) - (s.cy - s.ay) * (t.bx - s.ax)) <= 0
 AND sign((t.bx - t.ax) * (s.ay - t.ay) - (t.cy - t.ay) * (s.ax - t.ax)) * sign((t.bx - t.ax) * (s.cy - t.ay) - (t.cy - t.ay) * (s.bx - t.ax)) <= 0
WHERE s.bx IS NOT NULL AND t.bx IS NOT NULL"""

VIOLATION_CHECKS = [
    ("geo_type", "not null", "geo_type IS NULL"),
    ("neighborhood_type", "not null", "neighborhood_type IS NULL"),
    ("name", "length>200", "length(name) > 200"),
    ("state_abbr", "length>2", "length(state_abbr) > 2"),
    ("county_fips_code", "length>3", "length(county_fips_code) > 3"),
    ("latitude", "decimal(9,6)", "latitude IS NOT NULL AND TRY_CAST(latitude AS DECIMAL(9,6)) IS NULL"),
]
LANDING_ROWS = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in LANDING_ROW_SQL.items()) + " FROM customer"


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _vendor_rows() -> str:
    file = derive.VENDOR_FILE.replace("AS STRING", "AS VARCHAR")
    lineage = f"{file} AS file_name, '{derive.DELIVERY_DAY}' AS parent_folder_name FROM customer"
    headers = " ".join(f"WHEN '{s}' THEN '{derive.vendor_header(s)}'" for s in derive.VENDOR_ORDERS)
    line = derive.vendor_line(TAB)
    columns = STAGE_COLS.replace("  member AS geo_type, member AS neighborhood_type,\n", "")
    none = ", ".join(f"CAST(NULL AS {'DOUBLE' if f.name in ('longitude', 'latitude') else 'VARCHAR'}) AS {f.name}" for f in derive.NEIGHBORHOODS_RAW.fields if f.name != derive.BAD)
    known = "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"
    return _union([
        f"SELECT {columns}, CAST(NULL AS VARCHAR) AS _bad_data, {lineage} WHERE {known} AND c_acctbal >= 0",
        f"SELECT {none}, {line} AS _bad_data, {lineage} WHERE NOT ({known}) OR c_acctbal < 0",
        f"SELECT DISTINCT {none}, CASE c_mktsegment {headers} END AS _bad_data, {lineage} WHERE NOT ({known})",
    ])


def oracle_sql() -> dict:
    return {
        "stage_good_rows": f"SELECT '2024-01-15' AS load_date, {STAGE_COLS}, member AS file_name, "
                           f"'20240115' AS parent_folder_name FROM ({GOOD}) g",
        "stage_bad_rows": _union([
            f"SELECT {_bad_line()} AS _bad_data FROM ({CUST}) c WHERE c_acctbal < 0 OR c_nationkey = 24",
            f"SELECT '{HEADER}' AS _bad_data FROM (SELECT DISTINCT member FROM ({CUST}) c) m",
        ]),
        "curated_snapshot": f"SELECT {CURATED_COLS} FROM ({CURATED}) k",
        "history_partition_overwrite": _union([
            f"SELECT '2024-01-01' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g "
            f"WHERE CAST(c_acctbal / 100 AS DECIMAL(12,4)) >= 10 GROUP BY member",
            f"SELECT '2024-02-01' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g GROUP BY member",
        ]),
        "history_empty_reload": f"SELECT '2024-02-01' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g GROUP BY member",
        "load_date_fallback": _union([
            f"SELECT '2024-01-01' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g GROUP BY member",
            f"SELECT '2024-03-05' AS load_date, member AS geo_type, 2 * count(*) AS n FROM ({GOOD}) g GROUP BY member"]),
        "manifest_long_prefixes": "SELECT o_orderkey, o_orderstatus <> 'P' AS prefix_ok, CASE WHEN o_orderstatus <> 'P' THEN "
                                  "CAST(strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS HUGEINT) > "
                                  "CASE WHEN o_orderstatus = 'O' THEN 19970101 ELSE 19960101000000000000 END END AS is_new FROM orders",
        "shape_rejects": "SELECT p_partkey, CASE p_partkey % 10 WHEN 5 THEN 'unsupported type' WHEN 6 THEN 'unbalanced parentheses' "
                         "WHEN 7 THEN 'null text' WHEN 8 THEN 'unexpected character' ELSE 'bad coordinate' END AS problem "
                         "FROM part WHERE p_partkey % 10 <> 0",
        "incremental_stage": _union([
            f"SELECT '{d}' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g GROUP BY member"
            for d in ("2024-01-01", "2024-02-01")]),
        "contract_orc_scan": "SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS s_phone, s_acctbal, "
                             "CASE WHEN s_nationkey < 12 THEN '2024-01-01' ELSE '2024-02-01' END AS load_date FROM supplier",
        "prefix_map": "SELECT p_partkey, CASE p_type " + " ".join(
            f"WHEN '{t}' THEN 'neighborhood_lev_{c[1]}'" for t, c in PART_CODES[:4]) + " END AS geo_type, "
            "CASE p_type " + " ".join(f"WHEN '{t}' THEN 'Neighborhood Level {c[0]}'" for t, c in PART_CODES[:4])
            + " END AS neighborhood_type FROM part",
        "area_code": "SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_fips_code, "
                     "CASE WHEN c_mktsegment <> 'BUILDING' THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') END AS county_fips_code, "
                     "CASE WHEN c_mktsegment <> 'BUILDING' THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || "
                     "lpad(CAST(c_custkey AS VARCHAR), 3, '0') END AS fips_code FROM customer",
        "null_sentinels": "SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS metro, "
                          "CASE WHEN c_acctbal < 0 OR CAST(c_acctbal / 100 AS DECIMAL(9,6)) = 0 THEN NULL "
                          "ELSE CAST(CAST(c_acctbal / 100 AS DECIMAL(9,6)) AS DOUBLE) END AS longitude FROM customer",
        "strip_srid": "SELECT s_suppkey, regexp_replace(CASE WHEN s_acctbal < 0 THEN 'SRID=3857;' WHEN s_nationkey = 5 "
                      "THEN 'SRID=4326;SRID=4326;' ELSE 'SRID=4326;' END || 'POINT (' || CAST(s_nationkey AS VARCHAR) "
                      "|| ' ' || CAST(s_suppkey AS VARCHAR) || ')', 'SRID=4326;', '', 'g') AS geoloc FROM supplier",
        "wide_contract_projection": _wide_sql(),
        # the line is what the typed columns print, so its hash is the row's
        "wide_curated_rows": _union([
            f"SELECT 'curated' AS side, CAST(c_custkey AS VARCHAR) AS row_key, md5({WIDE_LINE}) AS row_hash "
            f"FROM customer WHERE NOT {derive.WIDE_BAD_SQL}",
            f"SELECT 'history' AS side, CAST(c_custkey AS VARCHAR) AS row_key, '2024-01-15' AS row_hash "
            f"FROM customer WHERE NOT {derive.WIDE_BAD_SQL}"]),
        "wide_bad_rows": f"SELECT {WIDE_LINE} AS _bad_data FROM customer WHERE {derive.WIDE_BAD_SQL}",
        "curated_table": f"SELECT {CURATED_COLS} FROM ({CURATED}) k",
        "shape_decisions": _union([
            f"SELECT 'spike' AS kind, p_partkey, {SPIKE_LEVEL} AS geoloc_reduced_level, 6 AS geoloc_points, "
            f"{SPIKE_POINTS} AS geoloc_reduced_points, CAST(NULL AS VARCHAR) AS problem FROM part",
            # at 60 degrees south a 0.01 degree hole is 0.56 km wide: its corners are 497 m off the diagonal, so it goes at 500 m
            "SELECT 'grid' AS kind, p_partkey, CASE WHEN p_partkey % 5 < 4 THEN 500 END AS geoloc_reduced_level, n AS geoloc_points, "
            "CASE WHEN p_partkey % 5 = 0 AND p_partkey % 120 = 0 THEN 5 ELSE n END AS geoloc_reduced_points, CASE WHEN p_partkey % 5 = 4 THEN 'ring crosses itself' END AS problem "
            "FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 10 WHEN 2 THEN 10 WHEN 4 THEN NULL ELSE 5 END AS n FROM part) g",
            "SELECT 'dateline' AS kind, p_partkey, CASE WHEN p_partkey % 2 = 1 THEN 500 END AS geoloc_reduced_level, "
            "CASE WHEN p_partkey % 2 = 1 THEN 5 END AS geoloc_points, CASE WHEN p_partkey % 2 = 1 THEN 5 END AS geoloc_reduced_points, "
            "CASE WHEN p_partkey % 2 = 0 THEN 'ring crosses itself' END AS problem FROM part"]),
        "manifest_new_inventory": INVENTORY,
        "combined_new_inventory": f"SELECT i.filename, i.product, i.file_date, w.last_date, "
                                  f"TRY_CAST(i.file_date AS INTEGER) IS NOT NULL AS prefix_ok, "
                                  f"TRY_CAST(i.file_date AS INTEGER) > CAST(w.last_date AS INTEGER) AS is_new "
                                  f"FROM ({ITEMS}) i CROSS JOIN (SELECT max(last_date) AS last_date FROM ({WATERMARKS}) m) w",
        "last_loaded_date": WATERMARKS,
        "combined_watermark": f"SELECT max(last_date) AS last_date, '20010801' AS upload_date, "
                              f"max(last_date) < '20010801' AS newer_upload FROM ({WATERMARKS}) w",
        "new_product_flag": f"SELECT p.product, coalesce(bool_or(i.is_new), false) AS has_new "
                            f"FROM (VALUES ('neighborhoods'), ('community_info')) p(product) "
                            f"LEFT JOIN ({INVENTORY}) i ON i.product = p.product GROUP BY p.product",
        "archive_unpack": "SELECT CASE o_orderstatus WHEN 'O' THEN 'community_info' ELSE 'neighborhoods' END AS product, "
                          "strftime(date_trunc('year', o_orderdate), '%Y%m%d') AS file_date, "
                          "CASE o_orderstatus WHEN 'O' THEN 'community-info' ELSE 'neighborhoods' END || '-' || "
                          "strftime(o_orderdate, '%Y%m') || '.tsv' AS member, "
                          f"concat_ws({TAB}, CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
                          "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), "
                          "o_orderpriority) AS value FROM orders",
        "delivery_ledger": f"WITH o AS (SELECT *, CASE o_orderstatus WHEN 'O' THEN 'community-info' ELSE 'neighborhoods' END AS word FROM orders), "
                           "a AS (SELECT DISTINCT strftime(date_trunc('year', o_orderdate), '%Y%m%d') || '-' || word || '-' || CAST(o_orderkey // 50000 AS VARCHAR) || '.zip' AS archive, "
                           "replace(word, '-', '_') AS product, strftime(date_trunc('year', o_orderdate), '%Y%m%d') AS file_date, "
                           "word || '-' || strftime(o_orderdate, '%Y%m') || '.tsv' AS member, year(o_orderdate) >= 1998 AS first, month(o_orderdate) % 2 = 0 AS other FROM o) "
                           "SELECT archive, product, file_date, member, CASE WHEN first THEN 'new' WHEN other THEN 'changed' ELSE 'resent' END AS arrival FROM a "
                           "UNION ALL SELECT DISTINCT archive, product, file_date, 'empty.tsv', CASE WHEN first THEN 'new' ELSE 'resent' END FROM a",
        "history_switch": _union([
            f"SELECT '2024-01-01' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g WHERE CAST(c_acctbal / 100 AS DECIMAL(12,4)) >= 10 GROUP BY member",
            f"SELECT '2024-03-01' AS load_date, member AS geo_type, count(*) AS n FROM ({GOOD}) g GROUP BY member",
            # the second drop's bad lines: headers and short rows of day 1, every line of day 2
            "SELECT 'bad', '', (SELECT count(*) FROM customer WHERE c_nationkey = 24 AND CAST(c_acctbal / 100 AS DECIMAL(12,4)) >= 10) + (SELECT count(*) FROM customer) "
            f"+ (SELECT count(DISTINCT member) FROM ({CUST}) c WHERE CAST(c_acctbal / 100 AS DECIMAL(12,4)) >= 10) + (SELECT count(DISTINCT member) FROM ({CUST}) c)"]),
        "header_bound_scan": _vendor_rows(),
        "publish_rows": PUBLISHABLE,
        "typed_rows": f"SELECT {CURATED_COLS}, 1 AS n_parts FROM ({PUBLISHABLE}) p WHERE fips_code IS NOT NULL",
        "publish_flow": f"SELECT 'shapes' AS what, count(*) AS n FROM ({PUBLISHABLE}) p WHERE fips_code IS NOT NULL UNION ALL "
                        f"SELECT 'typed_rejects', count(*) FROM ({PUBLISHABLE}) p WHERE fips_code IS NULL UNION ALL "
                        "SELECT * FROM (VALUES ('shape_rejects', 0), ('key_violations', 0), ('landing_tables', 0)) z",
        "publish_count": f"SELECT count(*) AS source_rows, count(*) AS target_rows FROM ({PUBLISHABLE}) p",
        "target_contract_violations": _union([
            f"SELECT geo_id, '{col}' AS column_name, '{rule}' AS rule FROM ({LANDING_ROWS}) l WHERE {cond}"
            for col, rule, cond in VIOLATION_CHECKS]),
        "wkt_vertices": f"SELECT p_partkey, part, ring, seq, round(lon, 6) AS lon, round(lat, 6) AS lat FROM ({VERTS}) v",
        "ring_orientation": f"SELECT p.p_partkey, t.part, t.ring, t.b AS before, t.a AS after "
                            f"FROM ({PARTS}) p JOIN {ORIENT} ON p.kind = t.kind",
        "polygon_area": AREA,
        "self_intersections": "SELECT p_partkey, 0 AS part, 0 AS ring, 0 AS seg_i, 2 AS seg_j FROM part WHERE p_partkey % 5 = 4",
        "simplify_ladder": f"SELECT p_partkey, {SPIKE_LEVEL} AS geoloc_reduced_level, {SPIKE_POINTS} AS n_points FROM part",
        "geography_wkb": WKB,
        "ring_faults": "SELECT p_partkey, problem, problem IS NULL AS has_shape FROM (SELECT p_partkey, CASE p_partkey % 12 "
                       + " ".join(f"WHEN {k} THEN '{problem}'" for k, (_, problem) in derive.FIT_KINDS.items() if problem) + " END AS problem FROM part) f",
        "polar_areas": f"SELECT p_partkey, round({2 * R * R / 1e6!r} * pi() * (1 - sin(radians(p_partkey % 30 + 60))), 2) AS area_km2, p_partkey % 2 = 0 AS runs_east FROM part",
        "valid_rungs": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 100 ELSE 500 END AS geoloc_reduced_level, CAST(NULL AS VARCHAR) AS problem FROM part",
        "great_circle_significance": GREAT_CIRCLE,
        "large_ring_crossings": LARGE_RINGS,
        "shape_table": f"SELECT geo_type, neighborhood_type, geo_id AS id, name, fips_code, state_abbr, state_fips_code, "
                       f"county, county_fips_code, metro, incorporated_place, longitude, latitude, geoloc, "
                       f"geoloc AS geoloc_reduced, 500 AS geoloc_reduced_level FROM ({CURATED}) k",
        "key_violations": f"SELECT fips_code, geo_id AS id, 'duplicate key' AS rule, CAST(2 AS BIGINT) AS n "
                          f"FROM ({CURATED}) k WHERE c_nationkey = 1",
    }
