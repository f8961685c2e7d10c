"""Operator inputs derived from the supplied tables.

No supplied table is a delivery, a manifest or a polygon, so each registered
query first turns whole tables into one with Spark (exact, replayable
expressions the DuckDB oracle repeats), then runs the operators on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.session import spread, tasks_for
from terrafold.sources.contract import BAD, NEIGHBORHOODS_RAW

E = F.expr

# --- fixed values: how derived rows are labelled ------------------------------
# market segment -> level code in the boundary file name ('9x' = unmapped)
SEGMENT_CODES = [("AUTOMOBILE", "1m"), ("BUILDING", "2n"), ("FURNITURE", "3b"), ("HOUSEHOLD", "4s")]
UNMAPPED_CODE = "9x"
# order status -> product words in a delivery name
STATUS_WORDS = [("F", "neighborhoods-1m"), ("O", "community-info"), ("P", "neighborhoods-community-info")]
DELIVERY_DAY = "20240115"
UPLOAD_STAMP = "2001-08-01T06:30:00.250Z"
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: str, pairs, default: str) -> str:
    body = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {col} {body} ELSE '{default}' END"


MEMBER_SQL = f"'neighborhoods-' || {_case('c_mktsegment', SEGMENT_CODES, UNMAPPED_CODE)} || '-boundaries.tsv'"


def _square_wkt(x0: str, y0: str, prefix: str = "SRID=4326;") -> str:
    pts = [(x0, y0), (f"{x0} + 1", y0), (f"{x0} + 1", f"{y0} + 1"), (x0, f"{y0} + 1"), (x0, y0)]
    body = " || ', ' || ".join(f"CAST({x} AS STRING) || ' ' || CAST({y} AS STRING)" for x, y in pts)
    return f"'{prefix}POLYGON ((' || {body} || '))'"


# The eleven raw fields of a boundary line, as SQL over ``customer``.
BOUNDARY_FIELDS_SQL = [
    "CAST(c_custkey AS STRING)",
    "CASE WHEN c_nationkey = 7 THEN '' ELSE c_name END",
    "substr(c_mktsegment, 1, 2)",
    "CAST(c_nationkey AS STRING)",
    "' ' || c_mktsegment || ' '",
    "CASE WHEN c_acctbal > 5000 THEN 'Place ' || CAST(c_nationkey AS STRING) ELSE '' END",
    "'County ' || CAST(c_nationkey AS STRING)",
    "CAST(c_custkey AS STRING)",
    "CASE WHEN c_acctbal < 0 THEN '(' || CAST(CAST(-c_acctbal / 100 AS DECIMAL(12,4)) AS STRING) || ')' "
    "ELSE CAST(CAST(c_acctbal / 100 AS DECIMAL(12,4)) AS STRING) END",
    "CAST(c_nationkey AS STRING) || '.5'",
    _square_wkt("c_nationkey", "(c_custkey % 80 - 40)"),
]
HEADER_LINE = "\t".join(f.name for f in NEIGHBORHOODS_RAW.fields if f.name != BAD)


def boundary_lines(customer: DataFrame, days=(DELIVERY_DAY,)) -> DataFrame:
    """Customers as raw boundary lines ``(product, file_date, member, value)``.

    Negative balances are written accounting style, ``(9.9428)``, which no
    decimal parser accepts; nation 24 rows are cut to five fields; every
    member starts with a header line. Those are the bad rows."""
    full = "concat_ws('\t', " + ", ".join(BOUNDARY_FIELDS_SQL) + ")"
    short = "concat_ws('\t', " + ", ".join(BOUNDARY_FIELDS_SQL[:5]) + ")"
    rows = spread(customer, tasks_for(customer)).select(E(MEMBER_SQL).alias("member"),
                           E(f"CASE WHEN c_nationkey = 24 THEN {short} ELSE {full} END").alias("value"))
    headers = rows.select("member").distinct().select("member", F.lit(HEADER_LINE).alias("value"))
    lines = rows.unionByName(headers)
    out = None
    for d in days:
        part = lines.select(F.lit("neighborhoods").alias("product"), F.lit(d).alias("file_date"), "member", "value")
        out = part if out is None else out.unionByName(part)
    return out


# --- wide rows: synthetic test data ------------------------------------------
WIDE_COLUMNS = 619
WIDE_CYCLE = ("decimal(16,4)", "int", "decimal(8,4)", "decimal(16,4)", "decimal(9,6)", "decimal(21,4)", "string")
WIDE_BAD_SQL = "(c_nationkey = 24 OR c_acctbal > 9900)"


def wide_types(n: int = WIDE_COLUMNS) -> list[str]:
    """A layout made up for the tests: key and name, then a cycle of types."""
    return (["string", "string"] + [WIDE_CYCLE[j % len(WIDE_CYCLE)] for j in range(max(0, n - 2))])[:n]


def wide_contract(n: int = WIDE_COLUMNS, with_bad: bool = True) -> T.StructType:
    fields = [T.StructField(f"c{j:03d}", T._parse_datatype_string(t), True) for j, t in enumerate(wide_types(n), 1)]
    return T.StructType(fields + ([T.StructField(BAD, T.StringType(), True)] if with_bad else []))


def wide_value_sql(j: int, dtype: str) -> str:
    """Text of column ``j`` (1-based), exactly as its type prints it. Its position is in
    the value, so no two columns agree; every fiftieth is empty for one nation, and the
    fourth is no integer where the balance is above 9900."""
    sign = "CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || "
    if j <= 2:
        return ["CAST(c_custkey AS STRING)", "c_name"][j - 1]
    text = {
        "string": f"'t{j} ' || c_mktsegment",
        "int": f"CAST(c_custkey + {j} AS STRING)",
        "decimal(16,4)": f"{sign}CAST(c_custkey + {j} AS STRING) || '.{j:04d}'",
        "decimal(8,4)": f"{sign}CAST((c_custkey + {j}) % 9000 + 1 AS STRING) || '.{j:04d}'",
        "decimal(9,6)": f"{sign}CAST(c_custkey % 179 + 1 AS STRING) || '.{j:06d}'",
        "decimal(21,4)": f"{sign}CAST(c_custkey * 1000003 + {j} AS STRING) || '.{j:04d}'",
    }[dtype]
    if j == 4:
        text = f"CASE WHEN c_acctbal > 9900 THEN 'x' ELSE '' END || {text}"
    return f"CASE WHEN c_nationkey = 5 THEN '' ELSE {text} END" if j % 50 == 12 else text


def wide_line_sql(n: int = WIDE_COLUMNS, tab: str = "'\t'") -> str:
    """All fields of one wide line."""
    return f"concat_ws({tab}, " + ", ".join(wide_value_sql(j, t) for j, t in enumerate(wide_types(n), 1)) + ")"


def wide_lines(customer: DataFrame, n: int = WIDE_COLUMNS, day: str = DELIVERY_DAY) -> DataFrame:
    """Customers as wide lines; those of nation 24 end after five fields."""
    lines = spread(customer, tasks_for(customer)).select("c_nationkey", E(wide_line_sql(n)).alias("line"))
    return lines.select(
        F.lit("community_info").alias("product"), F.lit(day).alias("file_date"),
        F.lit("community-info-areas.tsv").alias("member"),
        E("CASE WHEN c_nationkey = 24 THEN substring_index(line, '\t', 5) ELSE line END").alias("value"))


# --- delivery manifests -------------------------------------------------------
FILENAME_SQL = ("CASE WHEN o_orderpriority = '5-LOW' THEN 'pending' ELSE date_format(o_orderdate, 'yyyyMMdd') END"
                f" || '-' || {_case('o_orderstatus', STATUS_WORDS, 'other')} || '-' || CAST(o_orderkey AS STRING) || '.zip'")


def manifest_pages(orders: DataFrame, page_size: int = 1000) -> DataFrame:
    """Orders as inventory items, paged into manifest documents of at most
    ``page_size`` items (pages are key ranges, so no page can grow with a
    hot date), one JSON document per line."""
    items = orders.select((F.col("o_orderkey") / page_size).cast("long").alias("page"),
                          E(FILENAME_SQL).alias("filename")) \
        .withColumn("url", F.concat(F.lit("https://files.example.invalid/"), F.col("filename")))
    pages = items.groupBy("page").agg(F.collect_list(F.struct("filename", "url")).alias("inventory"))
    doc = F.struct(F.struct(F.lit(UPLOAD_STAMP).alias("last-updated"), F.col("inventory").alias("inventory")).alias("result"))
    return pages.select(F.to_json(doc).alias("value"))


def folder_listing(orders: DataFrame) -> DataFrame:
    """Folders already landed: neighborhoods got every delivery day of a
    filled order before 1998, community info every open-order day before
    1997; both folders also hold non-date names."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    nb = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    ci = orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")))
    dated = nb.select(F.lit("neighborhoods").alias("product"), day.alias("name")).unionByName(
        ci.select(F.lit("community_info").alias("product"), day.alias("name")))
    junk = orders.sparkSession.createDataFrame(
        [(p, n) for p in ("neighborhoods", "community_info") for n in ("tmp", "2022_01")], "product string, name string")
    return dated.unionByName(junk)


# --- archives -------------------------------------------------------------------
ORDER_LINE_SQL = ("concat_ws('\t', CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus, "
                  "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), date_format(o_orderdate, 'yyyy-MM-dd'), o_orderpriority)")
ARCHIVE_WORD_SQL = "CASE o_orderstatus WHEN 'O' THEN 'community-info' ELSE 'neighborhoods' END"


def archive_members(orders: DataFrame, chunk: int = 50000) -> DataFrame:
    """Orders as archive members: archive ``<yyyy0101>-<word>-<chunk>.zip``
    holds monthly members ``data/<word>-<yyyyMM>.tsv``; an archive is one
    year of one key range, so none holds more than ``chunk`` orders."""
    return spread(orders, tasks_for(orders)).select(
        E(f"date_format(date_trunc('YEAR', o_orderdate), 'yyyyMMdd') || '-' || {ARCHIVE_WORD_SQL} || '-' || "
          f"CAST(CAST(o_orderkey / {chunk} AS BIGINT) AS STRING) || '.zip'").alias("archive"),
        E(f"'data/' || {ARCHIVE_WORD_SQL} || '-' || date_format(o_orderdate, 'yyyyMM') || '.tsv'").alias("member"),
        E(ORDER_LINE_SQL).alias("value"))


def write_archives(members: DataFrame, folder: str) -> DataFrame:
    """Write one zip per archive (grouped by archive, each group a bounded
    key range) through pyarrow's file systems, so the same code writes to
    a local, HDFS or object-store folder. Each archive also carries a
    ``notes.txt`` and an empty ``data/empty.tsv``. Returns (archive, lines)."""
    def build(pdf):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs

        name = pdf["archive"].iloc[0]
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for member, grp in pdf.groupby("member", sort=True):
                zf.writestr(member, "".join(v + "\n" for v in sorted(grp["value"])))  # the same bytes on every run
            zf.writestr("notes.txt", "not a data file\n")
            zf.writestr("data/empty.tsv", "")
        filesystem, base = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        with filesystem.open_output_stream(f"{base}/{name}") as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"archive": [name], "lines": [len(pdf)]})

    return members.groupBy("archive").applyInPandas(build, "archive string, lines long")


def later_lines(orders: DataFrame) -> DataFrame:
    """The same archives delivered again: even months have corrected lines, and the years from 1998, which the first drop lacked, are there."""
    return archive_members(orders).withColumn("value", E("CASE WHEN member RLIKE '[02468][.]tsv$' THEN value || '*' ELSE value END"))


# --- vendor files with headers ------------------------------------------------------
VENDOR_NAMES = [f.metadata.get("original_name", f.name) for f in NEIGHBORHOODS_RAW.fields if f.name != BAD]
# column order by market segment: as the contract, reversed, or moved by four; the last segment's header has a name nobody knows
VENDOR_ORDERS = {"AUTOMOBILE": list(range(11)), "BUILDING": list(range(10, -1, -1)), "FURNITURE": [(i + 4) % 11 for i in range(11)],
                 "HOUSEHOLD": list(range(11)), "MACHINERY": list(range(11))}
VENDOR_FILE = f"'neighborhoods-' || {_case('c_mktsegment', SEGMENT_CODES, UNMAPPED_CODE)} || '-' || CAST(CAST(floor(c_custkey / 20000) AS BIGINT) AS STRING) || '.tsv'"


def vendor_header(segment: str) -> str:
    names = [VENDOR_NAMES[i] for i in VENDOR_ORDERS[segment]]
    return "\t".join(names[:-1] + ["unheard_of"] if segment == "MACHINERY" else names)


def vendor_line(tab: str = "'\t'") -> str:
    return "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN concat_ws({tab}, " + ", ".join(BOUNDARY_FIELDS_SQL[i] for i in o) + ")" for s, o in VENDOR_ORDERS.items()) + " END"


def write_vendor_files(customer: DataFrame, folder: str) -> DataFrame:
    """Customers as vendor-named files of a bounded key range each, with a header line and the segment's column order."""
    def build(pdf):
        import pandas as pd
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        with filesystem.open_output_stream(f"{base}/{pdf['file'].iloc[0]}") as out:
            out.write((pdf["header"].iloc[0] + "\n" + "".join(v + "\n" for v in sorted(pdf["value"]))).encode())
        return pd.DataFrame({"file": pdf["file"].iloc[:1], "lines": [len(pdf)]})

    header = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN '{vendor_header(s)}'" for s in VENDOR_ORDERS) + " END"
    rows = customer.select(E(VENDOR_FILE).alias("file"), E(header).alias("header"), E(vendor_line()).alias("value"))
    return rows.groupBy("file").applyInPandas(build, "file string, lines long")


# --- polygons ---------------------------------------------------------------------
def _hund(expr: str) -> str:
    """Hundredths (an integer expression) as exact decimal text."""
    return f"CAST(CAST(CAST({expr} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS STRING)"


def _pt(dx: int, dy: int) -> str:
    return f"{_hund(f'gx * 100 + {dx}')} || ' ' || {_hund(f'gy * 100 + {dy}')}"


def _ring(pts) -> str:
    return "'(' || " + " || ', ' || ".join(_pt(dx, dy) for dx, dy in pts) + " || ')'"


SQ = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
# Five shape kinds by part key modulo 5 (offsets in hundredths of a degree).
SHAPE_KINDS = {
    # counter-clockwise square with a repeated vertex and a clockwise hole
    0: "'POLYGON (' || " + _ring([(0, 0), (4, 0), (4, 0), (4, 4), (0, 4), (0, 0)]) + " || ', ' || "
       + _ring([(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]) + " || ')'",
    # clockwise square (must be reversed)
    1: "'POLYGON (' || " + _ring([(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]) + " || ')'",
    # two squares
    2: "'MULTIPOLYGON ((' || " + _ring(SQ) + " || '), (' || " + _ring([(x + 3, y) for x, y in SQ]) + " || '))'",
    # unclosed ring
    3: "'POLYGON (' || " + _ring([(0, 0), (2, 0), (2, 2), (0, 2)]) + " || ')'",
    # bow-tie: edges 0 and 2 cross
    4: "'POLYGON (' || " + _ring([(0, 0), (2, 1), (2, 0), (0, 2), (0, 0)]) + " || ')'",
}
SHAPE_SQL = "CASE p_partkey % 5 " + " ".join(f"WHEN {k} THEN {v}" for k, v in SHAPE_KINDS.items()) + " END"
GRID_X = "(p_partkey % 300 - 150)"
GRID_Y = "(p_partkey % 120 - 60)"


def part_shapes(part: DataFrame) -> DataFrame:
    """One polygon per part, five kinds by key; corners on a 0.01 degree grid."""
    return part.select("p_partkey", E(GRID_X).alias("gx"), E(GRID_Y).alias("gy")) \
               .select("p_partkey", E(SHAPE_SQL).alias("geoloc"))


# Spike squares for the reduction ladder: (side in degrees, spike depth in
# metres) by part key modulo 7; the spike's apex points out of the bottom
# edge's midpoint, so dropping it loses depth/(2*side) of the area.
SPIKES = [(0.01, 30), (0.01, 200), (0.01, 80), (0.002, 30), (0.001, 8), (0.0005, 4), (0.002, 20)]
METRES_PER_DEGREE = 6371008.8 * 3.141592653589793 / 180.0


def spike_shapes(part: DataFrame) -> DataFrame:
    k = "p_partkey % 7"
    side = "CASE " + " ".join(f"WHEN {k} = {i} THEN {s}D" for i, (s, _) in enumerate(SPIKES)) + " END"
    depth = "CASE " + " ".join(f"WHEN {k} = {i} THEN {d}D" for i, (_, d) in enumerate(SPIKES)) + " END"
    df = part.select("p_partkey",
                     E("(p_partkey % 300) * 0.5D - 75D").alias("x0"),
                     E("(p_partkey % 10) * 0.1D - 0.5D").alias("y0"),
                     E(side).alias("s"), E(f"({depth}) / {METRES_PER_DEGREE!r}D").alias("d"))

    def num(c: Column) -> Column:
        return F.format_string("%.9f", c)

    def pt(x: Column, y: Column) -> Column:
        return F.concat(num(x), F.lit(" "), num(y))

    x0, y0, s, d = F.col("x0"), F.col("y0"), F.col("s"), F.col("d")
    ring = F.concat_ws(", ", pt(x0, y0), pt(x0 + s / 2, y0 - d), pt(x0 + s, y0), pt(x0 + s, y0 + s),
                       pt(x0, y0 + s), pt(x0, y0))
    return df.select("p_partkey", F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("geoloc"))


def dateline_shapes(part: DataFrame) -> DataFrame:
    """One ring over the antimeridian per part: a square, or for even keys a bow-tie."""
    y = "p_partkey % 80"
    low, high = f"CAST({y} AS STRING)", f"CAST({y} + 1 AS STRING)"
    pts = [f"'179.9 ' || {low}", f"'-179.9 ' || {low}", f"'-179.9 ' || {high}", f"'179.7 ' || {high}"]

    def ring(order):
        return "'POLYGON ((' || " + " || ', ' || ".join(pts[i] for i in order) + " || '))'"

    return part.select("p_partkey", E(f"CASE WHEN p_partkey % 2 = 0 THEN {ring([0, 2, 1, 3, 0])} "
                                      f"ELSE {ring([0, 1, 2, 3, 0])} END").alias("geoloc"))


# Rings that do or do not fit together, by part key modulo 12 (offsets in hundredths of a degree), with the problem.
def _poly(*rings) -> str:
    return "'POLYGON (' || " + " || ', ' || ".join(_ring(r) for r in rings) + " || ')'"


def _multi(*parts) -> str:
    return "'MULTIPOLYGON (' || " + " || ', ' || ".join("'(' || " + " || ', ' || ".join(_ring(r) for r in p) + " || ')'" for p in parts) + " || ')'"


def _box(x: int, y: int, w: int, h: int):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


FIT_KINDS = {
    0: (_poly(_box(0, 0, 10, 10), _box(2, 2, 3, 3)), None),
    1: (_poly(_box(0, 0, 10, 10), _box(20, 2, 3, 3)), "hole outside its shell"),
    2: (_poly(_box(0, 0, 10, 10), _box(8, 2, 4, 3)), "hole crosses its shell"),
    3: (_poly(_box(0, 0, 10, 10), _box(1, 1, 4, 4), _box(3, 3, 4, 4)), "holes overlap"),
    4: (_poly(_box(0, 0, 10, 10), _box(1, 1, 6, 6), _box(2, 2, 2, 2)), "holes overlap"),
    5: (_multi([_box(0, 0, 10, 10)], [_box(5, 5, 10, 10)]), "parts overlap"),
    6: (_multi([_box(0, 0, 10, 10)], [_box(2, 2, 3, 3)]), "parts overlap"),
    7: (_multi([_box(0, 0, 10, 10), _box(2, 2, 6, 6)], [_box(3, 3, 2, 2)]), None),
    8: (_multi([_box(0, 0, 10, 10)], [_box(10, 0, 10, 10)]), None),
    9: (_poly(_box(0, 0, 10, 10), [(5, 0), (10, 5), (5, 10), (0, 5), (5, 0)]), None),
    10: (_poly([(0, 0), (10, 0), (10, 10), (5, 4), (0, 10), (0, 0)], [(0, 10), (10, 10), (5, 0), (0, 10)]), "hole crosses its shell"),
    11: (_poly([(0, 0), (20, 10), (20, 0), (0, 20), (0, 0)], _box(1, 1, 1, 1)), "ring crosses itself"),
}


def fitting_shapes(part: DataFrame) -> DataFrame:
    """One polygon per part, by key one of :data:`FIT_KINDS`."""
    kinds = "CASE p_partkey % 12 " + " ".join(f"WHEN {k} THEN {v}" for k, (v, _) in FIT_KINDS.items()) + " END"
    return part.select("p_partkey", E(GRID_X).alias("gx"), E(GRID_Y).alias("gy")).select("p_partkey", E(kinds).alias("geoloc"))


def polar_shapes(part: DataFrame) -> DataFrame:
    """One ring around a pole per part: 60 to 89 degrees by key, every eight steps of longitude, four ways (pole and sense)."""
    lat = "CAST((p_partkey % 30 + 60) * CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END AS STRING)"
    lon = "CAST((k * 45 + p_partkey % 45 + 180) % 360 - 180 AS STRING)"
    ring = (f"transform(CASE WHEN p_partkey % 4 < 2 THEN sequence(0, 8) ELSE sequence(8, 0) END, k -> {lon} || ' ' || {lat})")
    return part.select("p_partkey", E(f"'POLYGON ((' || array_join({ring}, ', ') || '))'").alias("geoloc"))


NOTCH = [(0.0, 0.0), (0.02, 0.0), (0.02, 0.02), (0.013, 0.02), (0.01, 0.01865), (0.007, 0.02), (0.0, 0.02), (0.0, 0.0)]
WEDGE = [(0.01, 0.0188), (0.016, 0.03), (0.004, 0.03), (0.01, 0.0188)]


def interlocked_shapes(part: DataFrame) -> DataFrame:
    """A square with a notch 150 m deep, and a large wedge whose tip stands in the notch (even keys) or above it (odd keys)."""
    def ring(points, up):
        pts = [f"format_string('%.6f %.6f', x0 + {x!r}D, y0 + {y + up!r}D)" for x, y in points]
        return "'((' || " + " || ', ' || ".join(pts) + " || '))'"
    df = part.select("p_partkey", E("(p_partkey % 300) * 0.5D - 75D").alias("x0"), E("(p_partkey % 10) * 0.1D - 0.5D").alias("y0"))
    wedge = f"CASE WHEN p_partkey % 2 = 0 THEN {ring(WEDGE, 0.0)} ELSE {ring(WEDGE, 0.01)} END"
    return df.select("p_partkey", E(f"'MULTIPOLYGON (' || {ring(NOTCH, 0.0)} || ', ' || {wedge} || ')'").alias("geoloc"))


TALL = ("p_partkey % 160 - 80", "p_partkey % 60 + 15")   # start latitude, rise of the ring in degrees


def tall_shapes(part: DataFrame) -> DataFrame:
    """A long triangle per part that starts at any latitude up to 80 degrees and spans up to 74: three distinct corners a, p, q."""
    lat, rise = TALL
    y2 = f"(CASE WHEN {lat} > 0 THEN ({lat}) - ({rise}) ELSE ({lat}) + ({rise}) END)"
    num = lambda v: f"CAST({v} AS STRING)"
    a, p, q = (f"{num('p_partkey % 90')} || ' ' || {num(lat)}", f"{num('p_partkey % 90 + 20')} || ' ' || {num(lat)}", f"{num('p_partkey % 90 + 50')} || ' ' || {num(y2)}")
    return part.select("p_partkey", E(f"'POLYGON ((' || {a} || ', ' || {p} || ', ' || {q} || ', ' || {a} || '))'").alias("geoloc"))


RING_CORNERS = 4000


def brand_rings(part: DataFrame) -> DataFrame:
    """One ring per brand and range of keys (so no ring outgrows it) with a corner per part, in key order: it staggers to the
    right and runs back below. Sixty-fourths of a degree are exact."""
    corner = "named_struct('k', p_partkey, 'd', CAST(p_partkey * 37 % 7 AS INT), 'y', CAST(p_partkey * 53 % 11 AS INT))"
    rings = part.groupBy("p_brand", E(f"p_partkey div {RING_CORNERS}").alias("block")).agg(F.sort_array(F.collect_list(E(corner))).alias("c"))
    at = "transform(c, (v, i) -> named_struct('x', (i * 2 + v.d) / 64D, 'y', v.y / 64D))"
    back = "array(named_struct('x', (size(c) * 2 + 9) / 64D, 'y', -1D), named_struct('x', -1D, 'y', -1D), get(p, 0))"
    return rings.select("p_brand", "block", "c", E(at).alias("p")).select("p_brand", "block", E(f"array(array(concat(p, {back})))").alias("shape"))
