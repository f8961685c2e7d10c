"""Registered queries over the supplied tables, and their DuckDB oracles.

Each query derives an operator's input from whole supplied tables (see
``derive``), runs the operators as Spark jobs, and returns a DataFrame with
no clock columns. The oracle states the expected result in plain SQL over
the same tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.functions import clean, geo
from terrafold.operators import curate, delivery, geometry, landing, publish
from terrafold.plans import boundaries as flows
from terrafold.plans import catalog, derive
from terrafold.session import apply_job_conf, scratch, tasks_for
from terrafold.sources import archive
from terrafold.sources.contract import BAD, NEIGHBORHOODS_RAW, NEIGHBORHOODS_STAGE
from terrafold.sources.contract import load as load_contract
from terrafold.sources.contract import save as save_contract
from terrafold.sources.delimited import scan_headed

def _decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Stage and curate
# ---------------------------------------------------------------------------

def q_stage_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = flows.staged_customers(spark, sf_dir)
    h = spark.read.orc(st.history)
    out = h.drop("created_datetime").withColumn("load_date", F.col("load_date").cast("string"))
    return _decimals_to_double(out)


def q_stage_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = flows.staged_customers(spark, sf_dir)
    return spark.read.text(st.bad).select(F.col("value").alias(BAD))


def q_curated_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decimals_to_double(flows.curated_customers(spark, sf_dir).drop("created_datetime"))


def q_history_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    base = scratch(spark, "history")
    raw, history = f"{base}/raw", f"{base}/stage"
    days = ["20240101", "20240201"]
    landing.land(derive.boundary_lines(derive.table(spark, sf_dir, "customer"), days), raw)
    flows.stage_boundaries(spark, raw, history, days=days)                   # both days
    smaller = derive.table(spark, sf_dir, "customer").where("CAST(c_acctbal / 100 AS DECIMAL(12,4)) >= 10")
    landing.land(derive.boundary_lines(smaller, days[:1]), f"{base}/again")  # day 1 comes again, with fewer rows
    flows.stage_boundaries(spark, f"{base}/again", history, f"{base}/bad", days=days[:1], load_date="2024-01-01")
    table = f"tf_stage.neighborhoods_hist_{uuid.uuid4().hex[:8]}"
    catalog.register(spark, NEIGHBORHOODS_STAGE, table, history, partition_by="load_date")
    return (spark.table(table).groupBy(F.col("load_date").cast("string").alias("load_date"), "geo_type")
            .agg(F.count(F.lit(1)).alias("n")))


def q_history_empty_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 comes again with malformed lines only: its old rows must go, and day 2 stay."""
    apply_job_conf(spark)
    base = scratch(spark, "reload")
    history, days = f"{base}/stage", ["20240101", "20240201"]
    customer = derive.table(spark, sf_dir, "customer")
    landing.land(derive.boundary_lines(customer, days), f"{base}/raw")
    flows.stage_boundaries(spark, f"{base}/raw", history, f"{base}/bad", days=days)
    broken = derive.boundary_lines(customer, days[:1]).withColumn("value", F.lit("no fields at all"))
    landing.land(broken, f"{base}/again")
    flows.stage_boundaries(spark, f"{base}/again", history, f"{base}/bad2", days=days[:1])
    return (spark.read.orc(history).groupBy(F.col("load_date").cast("string").alias("load_date"), "geo_type")
            .agg(F.count(F.lit(1)).alias("n")))


def q_load_date_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that are a date, an impossible date and no date: the last two take the run's date."""
    apply_job_conf(spark)
    base = scratch(spark, "fallback")
    days = ["20240101", "20241399", "latest"]
    landing.land(derive.boundary_lines(derive.table(spark, sf_dir, "customer"), days), f"{base}/raw")
    flows.stage_boundaries(spark, f"{base}/raw", f"{base}/stage", f"{base}/bad", days=days, run_date="2024-03-05")
    return (spark.read.orc(f"{base}/stage").groupBy(F.col("load_date").cast("string").alias("load_date"), "geo_type")
            .agg(F.count(F.lit(1)).alias("n")))


def q_history_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as a table whose dates change over by location: two days land, day 1 comes again with fewer rows and day 2 with none good."""
    apply_job_conf(spark)
    base, days = scratch(spark, "switch"), ["20240101", "20240201", "20240301"]
    customer = derive.table(spark, sf_dir, "customer")
    table = f"tf_stage.neighborhoods_switch_{uuid.uuid4().hex[:8]}"
    catalog.register(spark, NEIGHBORHOODS_STAGE, table, f"{base}/table", partition_by="load_date", repair=False)
    smaller = customer.where("CAST(c_acctbal / 100 AS DECIMAL(12,4)) >= 10")
    broken = derive.boundary_lines(customer, days[1:2]).withColumn("value", F.lit("no fields at all"))
    landing.land(derive.boundary_lines(customer, days), f"{base}/one")
    landing.land(derive.boundary_lines(smaller, days[:1]).unionByName(broken), f"{base}/two")
    seen = []
    for name, some in (("one", days), ("two", days[:2])):
        seen.append(flows.reload_boundaries(spark, f"{base}/{name}", table, f"{base}/runs", f"{base}/bad-{name}", days=some))
    got = spark.table(table).groupBy(F.col("load_date").cast("string").alias("load_date"), "geo_type").agg(F.count(F.lit(1)).alias("n"))
    bad = spark.read.text(f"{base}/bad-two").groupBy(F.lit("bad").alias("load_date"), F.lit("").alias("geo_type")).agg(F.count(F.lit(1)).alias("n"))
    return got.unionByName(bad)


def q_header_bound_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor files in the vendor's layout, each with its own column order; a file with an unknown header is bad rows."""
    folder = f"{scratch(spark, 'vendor')}/{derive.DELIVERY_DAY}"
    derive.write_vendor_files(derive.table(spark, sf_dir, "customer"), folder).agg(F.sum("lines")).collect()
    rows = scan_headed(spark, folder, NEIGHBORHOODS_RAW, prefix="neighborhoods")
    # all columns: a narrower read would not see the values that do not fit
    typed = [F.when(F.col(BAD).isNull(), F.col(f.name)).alias(f.name) for f in NEIGHBORHOODS_RAW.fields if f.name != BAD]
    return _decimals_to_double(rows.select(*typed, BAD, "file_name", "parent_folder_name"))


def q_incremental_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage job driven by a file stream: two deliveries land one after
    the other; each availableNow run restages only the new date."""
    from terrafold.streaming import incremental

    apply_job_conf(spark)
    base = scratch(spark, "incremental")
    raw, history, bad, ckpt = f"{base}/raw", f"{base}/stage", f"{base}/bad", f"{base}/_checkpoint"
    customer = derive.table(spark, sf_dir, "customer")

    def restage(days):
        flows.stage_boundaries(spark, raw, history, bad, days=days, bad_by="parent_folder_name")

    runs = []
    for day in ("20240101", "20240201"):
        landing.land(derive.boundary_lines(customer, [day]), raw)
        runs.append(incremental.run(spark, raw, restage, checkpoint=ckpt, prefix="neighborhoods"))
    if runs != [["20240101"], ["20240201"]]:
        raise RuntimeError(f"each run should restage only its new date, got {runs}")
    return (spark.read.orc(history).groupBy(F.col("load_date").cast("string").alias("load_date"), "geo_type")
            .agg(F.count(F.lit(1)).alias("n")))


SUPPLIER_CONTRACT = T.StructType([
    T.StructField("created_datetime", T.TimestampType()), T.StructField("s_suppkey", T.LongType()),
    T.StructField("s_name", T.StringType()), T.StructField("s_phone", T.StringType()),
    T.StructField("s_acctbal", T.DoubleType()), T.StructField("load_date", T.DateType()),
    T.StructField(BAD, T.StringType()),
])


def q_contract_orc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "orc-scan")
    s = derive.table(spark, sf_dir, "supplier").select(
        F.current_timestamp().alias("created_datetime"), "s_suppkey", "s_name", "s_acctbal",
        F.lit("x").alias("x_extra"),
        F.when(F.col("s_nationkey") < 12, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("date").alias("load_date"))
    s.write.mode("overwrite").partitionBy("load_date").orc(path)
    df = curate.scan(spark, path, SUPPLIER_CONTRACT)
    return curate.drop_audit(df, ("created_datetime", BAD)).withColumn("load_date", F.col("load_date").cast("string"))


PART_CODES = [("ECONOMY", "1m"), ("LARGE", "2n"), ("MEDIUM", "3b"), ("PROMO", "4s"), ("SMALL", "5x")]


def q_prefix_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = derive._case("p_type", PART_CODES, "")
    p = derive.table(spark, sf_dir, "part").select("p_partkey", F.expr(f"'neighborhoods-' || {code} || '-part.tsv'").alias("f"))
    return p.select("p_partkey", clean.prefix_map("f", clean.GEO_TYPE_RULES).alias("geo_type"),
                    clean.prefix_map("f", clean.NEIGHBORHOOD_TYPE_RULES).alias("neighborhood_type"))


def q_area_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = derive.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("s"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")).alias("k"))
    return c.select("c_custkey", clean.pad_code("s", 2).alias("state_fips_code"),
                    clean.pad_code("k", 3).alias("county_fips_code"), clean.area_code("s", 2, "k", 3).alias("fips_code"))


def q_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = derive.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("")).otherwise(F.col("c_mktsegment")).alias("metro"),
        F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(F.col("c_acctbal") / 100).cast("decimal(9,6)").alias("longitude"))
    return c.select("c_custkey", clean.nullif("metro", "").alias("metro"),
                    clean.nullif("longitude", 0).cast("double").alias("longitude"))


def q_strip_srid(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derive.table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(
        "CASE WHEN s_acctbal < 0 THEN 'SRID=3857;' WHEN s_nationkey = 5 THEN 'SRID=4326;SRID=4326;' ELSE 'SRID=4326;' END"
        " || 'POINT (' || CAST(s_nationkey AS STRING) || ' ' || CAST(s_suppkey AS STRING) || ')'").alias("geoloc"))
    return s.select("s_suppkey", clean.strip_srid("geoloc").alias("geoloc"))


def _wide_staged(spark: SparkSession, sf_dir: str):
    """The wide drop landed and staged by a contract read from a file; returns ``(folder, contract)``."""
    from terrafold.plans import community

    apply_job_conf(spark)
    base = scratch(spark, "wide")
    contract = load_contract(save_contract(derive.wide_contract(), f"{base}/contract", spark), spark)
    # one file per writer task: the single wide member is parsed in parallel
    landing.land(derive.wide_lines(derive.table(spark, sf_dir, "customer")), f"{base}/raw", rebalance=False)
    community.stage_community(spark, f"{base}/raw", contract, f"{base}/stage", f"{base}/bad",
                              days=[derive.DELIVERY_DAY], load_date="2024-01-15")
    return base, contract


def q_wide_contract_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrafold.plans import community

    base, contract = _wide_staged(spark, sf_dir)
    return community.column_totals(community.curate_community(spark, f"{base}/stage", contract), contract)


def q_wide_curated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every curated wide row through the catalog: its key, its load date in the history, a hash over all columns in order."""
    from terrafold.plans import community

    base, contract = _wide_staged(spark, sf_dir)
    community.curate_community(spark, f"{base}/stage", contract, f"{base}/curated")
    mark = uuid.uuid4().hex[:8]
    hist, cur = f"tf_stage.community_hist_{mark}", f"tf_curated.community_{mark}"
    community.register_community(spark, contract, f"{base}/stage", f"{base}/curated", hist, cur)
    rows = community.row_hashes(spark.table(cur), "c001", contract).select(F.lit("curated").alias("side"), "row_key", "row_hash")
    kept = spark.table(hist).select(F.lit("history").alias("side"), F.col("c001").alias("row_key"),
                                    F.col("load_date").cast("string").alias("row_hash"))
    return rows.unionByName(kept)


def q_wide_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _contract = _wide_staged(spark, sf_dir)
    return spark.read.text(f"{base}/bad").select(F.col("value").alias(BAD))


def q_curated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated boundaries as an external table with the empty-as-null property."""
    st = flows.staged_customers(spark, sf_dir)
    path = st.history.replace("/stage", "/curated")
    flows.curate_boundaries(spark, st.history, path)
    table = f"tf_curated.neighborhoods_{uuid.uuid4().hex[:8]}"
    catalog.register(spark, T.StructType([f for f in NEIGHBORHOODS_STAGE.fields if f.name not in ("load_date", BAD)]),
                     table, path, properties=catalog.EMPTY_AS_NULL_PROPERTIES)
    return _decimals_to_double(spark.table(table).drop("created_datetime"))


# ---------------------------------------------------------------------------
# Delivery discovery (M1-M9)
# ---------------------------------------------------------------------------

PRODUCTS = ["neighborhoods", "community_info"]


def _manifest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "manifest")
    derive.manifest_pages(derive.table(spark, sf_dir, "orders")).write.mode("overwrite").text(path)
    return delivery.manifest(spark, path)


def _watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = derive.folder_listing(derive.table(spark, sf_dir, "orders"))
    return delivery.last_loaded(listing, products=PRODUCTS)


def q_manifest_new_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = delivery.new_inventory(_manifest_items(spark, sf_dir), _watermarks(spark, sf_dir), products=PRODUCTS)
    return inv.select("filename", "product", "file_date", "upload_date", "last_date", "prefix_ok", "is_new")


def q_combined_new_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item against one mark, the latest over the products (M8)."""
    inv = delivery.new_inventory(_manifest_items(spark, sf_dir), _watermarks(spark, sf_dir), combined_mark=True)
    return inv.select("filename", "product", "file_date", "last_date", "prefix_ok", "is_new")


def q_manifest_long_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixes far above the integer range, and some that are no number."""
    items = derive.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("CASE WHEN o_orderstatus = 'O' THEN 'community_info' ELSE 'neighborhoods' END").alias("product"),
        F.expr("CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END || date_format(o_orderdate, 'yyyyMMdd') || lpad(CAST(o_orderkey AS STRING), 12, '0')").alias("file_date"))
    marks = spark.createDataFrame([("neighborhoods", "19960101000000000000"), ("community_info", "19970101")], "product string, last_date string")
    return delivery.new_inventory(items, marks).select("o_orderkey", "prefix_ok", "is_new")


def q_last_loaded_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watermarks(spark, sf_dir)


def q_combined_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = delivery.upload_date(_manifest_items(spark, sf_dir))
    wm = delivery.combined(_watermarks(spark, sf_dir))
    both = up.select(F.lit(None).cast("string").alias("last_date"), "upload_date").unionByName(
        wm.select("last_date", F.lit(None).cast("string").alias("upload_date")))
    row = both.agg(F.max("last_date").alias("last_date"), F.max("upload_date").alias("upload_date"))
    return row.withColumn("newer_upload", delivery.gate(F.col("last_date"), F.col("upload_date")))


def q_new_product_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = delivery.new_inventory(_manifest_items(spark, sf_dir), _watermarks(spark, sf_dir))
    return delivery.new_product_flags(inv)


def q_archive_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_job_conf(spark)
    base = scratch(spark, "archives")
    members = derive.archive_members(derive.table(spark, sf_dir, "orders"))
    derive.write_archives(members, f"{base}/zips").agg(F.sum("lines")).collect()  # materialise the drop
    lines = landing.label(archive.unpack(spark, f"{base}/zips"))
    landing.land(lines, f"{base}/raw")
    back = spark.read.text(f"{base}/raw")
    return back.select("product", F.col("file_date").cast("string").alias("file_date"), "member", "value")


def q_delivery_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops against the ledger: members landed as they are, with other content, and for the first time."""
    base, orders = scratch(spark, "ledger"), derive.table(spark, sf_dir, "orders")
    first = derive.archive_members(orders.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'"))
    for lines, name in ((first, "one"), (derive.later_lines(orders), "two")):
        derive.write_archives(lines, f"{base}/{name}").agg(F.sum("lines")).collect()
    landing.record(landing.label(archive.members(spark, f"{base}/one")), f"{base}/ledger")
    got = landing.arrivals(landing.label(archive.members(spark, f"{base}/two")), landing.ledger(spark, f"{base}/ledger"))
    return got.select("archive", "product", "file_date", "member", "arrival")


# ---------------------------------------------------------------------------
# Publish (P1-P5)
# ---------------------------------------------------------------------------

LANDING_DDL = """CREATE TABLE {table} (
  created_datetime TIMESTAMP DEFAULT current_timestamp(),
  geo_type STRING, neighborhood_type STRING, geo_id STRING, name STRING, fips_code STRING,
  state_abbr STRING, state_fips_code STRING, metro STRING, incorporated_place STRING, county STRING,
  county_fips_code STRING, longitude DECIMAL(9,6), latitude DECIMAL(9,6), geoloc STRING
) USING PARQUET
LOCATION '{location}'"""


def _published(spark: SparkSession, sf_dir: str):
    curated = flows.curated_customers(spark, sf_dir)
    ok, _bad = publish.split_violations(curated, publish.LANDING_RULES)
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_publish")
    table = f"tf_publish.neighborhoods_landing_{uuid.uuid4().hex[:8]}"
    spark.sql(LANDING_DDL.format(table=table, location=scratch(spark, "publish")))
    publish.load_table(ok, table)
    return curated, ok, table


def q_publish_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _curated, _ok, table = _published(spark, sf_dir)
    return _decimals_to_double(spark.table(table).drop("created_datetime"))


def q_publish_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _curated, ok, table = _published(spark, sf_dir)
    src = ok.agg(F.count(F.lit(1)).alias("n")).select(F.lit("source").alias("side"), "n")
    tgt = spark.table(table).agg(F.count(F.lit(1)).alias("n")).select(F.lit("target").alias("side"), "n")
    return src.unionByName(tgt).agg(
        F.max(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"))


def q_publish_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract check, load, typed check, shapes, key gate and staging clean-up in one go (P1-P5, G1-G12): what came of the rows."""
    curated, _ok, table = _published(spark, sf_dir)
    path = scratch(spark, "flow")
    out = flows.publish_and_shape(spark, curated, table, path)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    left = F.lit(int(spark.catalog.tableExists(table))).cast("long")
    got = count(out.shapes, "shapes").unionByName(count(out.typed_rejects, "typed_rejects")).unionByName(count(out.shape_rejects, "shape_rejects"))
    got = got.unionByName(count(out.key_violations, "key_violations"))
    return got.unionByName(spark.range(1).select(F.lit("landing_tables").alias("what"), left.alias("n")))


def q_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows that meet the typed contract, typed, with the parts of their shape (P5)."""
    _curated, _ok, table = _published(spark, sf_dir)
    ok, _rejects = publish.split_violations(spark.table(table), publish.TYPED_RULES)
    typed = publish.typed(ok).withColumn("n_parts", F.size("shape")).drop("created_datetime", "shape")
    return _decimals_to_double(typed)


LANDING_ROW_SQL = {
    "geo_type": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'neighborhood_lev_m' WHEN 'BUILDING' THEN 'neighborhood_lev_n' "
                "WHEN 'FURNITURE' THEN 'neighborhood_lev_b' WHEN 'HOUSEHOLD' THEN 'neighborhood_lev_s' END",
    "neighborhood_type": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Neighborhood Level 1' WHEN 'BUILDING' THEN "
                         "'Neighborhood Level 2' WHEN 'FURNITURE' THEN 'Neighborhood Level 3' WHEN 'HOUSEHOLD' THEN "
                         "'Neighborhood Level 4' END",
    "geo_id": "'G' || CAST(c_custkey AS STRING)",
    "name": "CASE WHEN c_nationkey = 3 THEN repeat(c_name, 12) ELSE c_name END",
    "fips_code": "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE lpad(CAST(c_nationkey AS STRING), 2, '0') || "
                 "lpad(CAST(c_custkey AS STRING), 3, '0') END",
    "state_abbr": "CASE WHEN c_nationkey = 5 THEN substr(c_mktsegment, 1, 3) ELSE substr(c_mktsegment, 1, 2) END",
    "state_fips_code": "lpad(CAST(c_nationkey AS STRING), 2, '0')",
    "metro": "c_mktsegment",
    "incorporated_place": "CAST(NULL AS STRING)",
    "county": "'County ' || CAST(c_nationkey AS STRING)",
    "county_fips_code": "CAST(c_custkey AS STRING)",
    "longitude": "c_acctbal / 10",
    "latitude": "CAST(c_nationkey * 50 AS DOUBLE)",
}


def q_target_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.table(spark, sf_dir, "customer").select(*[F.expr(v).alias(k) for k, v in LANDING_ROW_SQL.items()])
    v = publish.violations(rows, publish.LANDING_RULES, key="geo_id")
    return v.withColumnRenamed("column", "column_name")


# ---------------------------------------------------------------------------
# Geometry (G1-G12)
# ---------------------------------------------------------------------------

def _vertices(df: DataFrame):
    return geometry.vertices_shapes(df, partitions=tasks_for(df))


def _part_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _rejects = _vertices(derive.part_shapes(derive.table(spark, sf_dir, "part")))
    return ok


def q_wkt_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = geometry.vertices(geometry.clean(_part_shapes(spark, sf_dir)), "p_partkey")
    return v.select("p_partkey", "part", "ring", "seq", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


REJECT_TEXTS = {
    0: ("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))", None), 1: ("POLYGON ((NaN 0, 1 0, 1 1, 0 1, NaN 0))", "bad coordinate"),
    2: ("POLYGON ((Infinity 0, 1 0, 1 1, Infinity 0))", "bad coordinate"), 3: ("POLYGON ((1e30 0, 1 0, 1 1, 1e30 0))", "bad coordinate"),
    4: ("POLYGON ((0 95, 1 0, 1 1, 0 95))", "bad coordinate"), 5: ("POINT (1 2)", "unsupported type"),
    6: ("POLYGON ((0 0, 1 0, 1 1, 0 0)", "unbalanced parentheses"), 7: (None, "null text"), 8: ("POLYGON ((0 0, 1 #, 1 1, 0 0))", "unexpected character"),
    9: ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 181 6, 5 5)))", "bad coordinate"),
}


def q_shape_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part carries one of the texts; all but the first must be rejected, with the reason."""
    text = "CASE p_partkey % 10 " + " ".join(f"WHEN {k} THEN " + ("NULL" if t is None else f"'{t}'") for k, (t, _) in REJECT_TEXTS.items()) + " END"
    _ok, rejects = _vertices(derive.table(spark, sf_dir, "part").select("p_partkey", F.expr(text).alias("geoloc")))
    return rejects.select("p_partkey", "problem")


def q_geography_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned shapes as well-known binary (P5), and whether it reads back as the same shape."""
    s = geometry.once(geometry.clean(_part_shapes(spark, sf_dir)).select("p_partkey", "shape"), wkb=geo.to_wkb("shape"))
    s = geometry.once(s, back=geo.from_wkb("wkb"))
    return s.select("p_partkey", F.hex("wkb").alias("wkb"), (F.col("back") == F.col("shape")).alias("same"))


def q_ring_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = geometry.once(_part_shapes(spark, sf_dir).select("p_partkey", "shape"), before=geo.clean_shape("shape"))
    s = geometry.once(s.drop("shape"), after=geo.orient_shape("before"))
    p, q, r1, r2 = "p_o", "q_o", "r_o1", "r_o2"
    pairs = (f"zip_with(before, after, ({p}, {q}) -> zip_with({p}, {q}, ({r1}, {r2}) -> "
             f"named_struct('before', {geo.orientation(r1)}, 'after', {geo.orientation(r2)})))")
    p = s.select("p_partkey", F.posexplode(F.expr(pairs)).alias("part", "_p"))
    r = p.select("p_partkey", "part", F.posexplode("_p").alias("ring", "_r"))
    return r.select("p_partkey", "part", "ring", F.col("_r.before").alias("before"), F.col("_r.after").alias("after"))


def q_polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = geometry.area(geometry.clean(_part_shapes(spark, sf_dir)))
    return s.select("p_partkey", F.round("area_m2", 1).alias("area_m2"))


def q_self_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.crossings(geometry.clean(_part_shapes(spark, sf_dir)), "p_partkey")


def q_simplify_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = _vertices(derive.spike_shapes(derive.table(spark, sf_dir, "part")))
    r = geometry.reduce(geometry.significance(geometry.clean(ok)))
    return r.select("p_partkey", F.col("reduced_level").cast("int").alias("geoloc_reduced_level"),
                    F.size(F.get(F.get("reduced", 0), 0)).alias("n_points"))


def q_shape_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole shape job over spiked, reversed, multi-part, holed, open and self-crossing
    polygons: the chosen level and the points before and after, or the reason of the reject."""
    part = derive.table(spark, sf_dir, "part")
    texts = derive.spike_shapes(part).withColumn("kind", F.lit("spike")).unionByName(
        derive.part_shapes(part).withColumn("kind", F.lit("grid"))).unionByName(
        derive.dateline_shapes(part).withColumn("kind", F.lit("dateline")))
    table, rejects = geometry.shapes(texts, id_col="p_partkey", partitions=tasks_for(texts))
    points = lambda c: F.size(F.split(c, ",")).alias(f"{c}_points")
    none = F.lit(None)
    return table.select("kind", F.col("id").alias("p_partkey"), "geoloc_reduced_level", points("geoloc"), points("geoloc_reduced"),
                        none.cast("string").alias("problem")).unionByName(
        rejects.select("kind", "p_partkey", *[none.cast("int").alias(c) for c in
                                              ("geoloc_reduced_level", "geoloc_points", "geoloc_reduced_points")], "problem"))


def q_ring_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes whose rings fit together or not: a hole outside or across its shell, holes or parts that overlap, rings that only touch."""
    texts = derive.fitting_shapes(derive.table(spark, sf_dir, "part"))
    return geometry.outcomes(texts, partitions=tasks_for(texts)).select("p_partkey", "problem", F.col("_wkt").isNotNull().alias("has_shape"))


def q_polar_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings around either pole in either sense: the area is the cap's, and cleaning turns the pole to the left."""
    ok, _ = _vertices(derive.polar_shapes(derive.table(spark, sf_dir, "part")))
    first = "get(get(get(shape, 0), 0), {i}).x"
    east = f"pmod({first.format(i=1)} - {first.format(i=0)} + 180D, 360D) - 180D > 0"
    return geometry.clean(ok).select("p_partkey", F.round(F.col("area_m2") / 1e6, 2).alias("area_km2"), F.expr(east).alias("runs_east"))


def q_valid_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rung whose reduced parts overlap is skipped, however much area it keeps."""
    texts = derive.interlocked_shapes(derive.table(spark, sf_dir, "part"))
    return geometry.outcomes(texts, partitions=tasks_for(texts)).select("p_partkey", F.col("_level").alias("geoloc_reduced_level"), "problem")


def q_great_circle_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Significance of the corners of tall rings at any latitude, in whole metres."""
    ok, _ = _vertices(derive.tall_shapes(derive.table(spark, sf_dir, "part")))
    s = geometry.significance(ok).select("p_partkey", F.posexplode(F.expr("get(get(sig, 0), 0)")).alias("seq", "sig"))
    return s.where("seq IN (1, 2)").select("p_partkey", "seq", F.round("sig").alias("sig_m"))


def q_large_ring_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossings of one long ring per brand, met tile by tile."""
    return geometry.crossings(derive.brand_rings(derive.table(spark, sf_dir, "part")), ["p_brand", "block"], split_edges=50)


def _shape_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = flows.curated_customers(spark, sf_dir)
    table, _rejects = geometry.shapes(curated, partitions=tasks_for(curated))
    return table.select(*[c for c in geometry.SHAPE_COLUMNS if c in table.columns])


def q_shape_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decimals_to_double(_shape_table(spark, sf_dir).drop("created_datetime"))


def q_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "shape-keys")  # the shapes are built once, for both sides of the union
    _shape_table(spark, sf_dir).select("fips_code", "id", "state_fips_code").write.parquet(path)
    t = spark.read.parquet(path)
    with_dupes = t.unionByName(t.where(F.col("state_fips_code") == "01"))
    return geometry.key_violations(with_dupes)


QUERIES = {
    "stage_good_rows": q_stage_good_rows,
    "stage_bad_rows": q_stage_bad_rows,
    "curated_snapshot": q_curated_snapshot,
    "history_partition_overwrite": q_history_partition_overwrite,
    "history_empty_reload": q_history_empty_reload,
    "load_date_fallback": q_load_date_fallback,
    "manifest_long_prefixes": q_manifest_long_prefixes,
    "shape_rejects": q_shape_rejects,
    "incremental_stage": q_incremental_stage,
    "contract_orc_scan": q_contract_orc_scan,
    "prefix_map": q_prefix_map,
    "area_code": q_area_code,
    "null_sentinels": q_null_sentinels,
    "strip_srid": q_strip_srid,
    "wide_contract_projection": q_wide_contract_projection,
    "wide_curated_rows": q_wide_curated_rows,
    "wide_bad_rows": q_wide_bad_rows,
    "curated_table": q_curated_table,
    "shape_decisions": q_shape_decisions,
    "manifest_new_inventory": q_manifest_new_inventory,
    "last_loaded_date": q_last_loaded_date,
    "combined_watermark": q_combined_watermark,
    "new_product_flag": q_new_product_flag,
    "combined_new_inventory": q_combined_new_inventory,
    "archive_unpack": q_archive_unpack,
    "delivery_ledger": q_delivery_ledger,
    "history_switch": q_history_switch,
    "header_bound_scan": q_header_bound_scan,
    "publish_rows": q_publish_rows,
    "publish_count": q_publish_count,
    "typed_rows": q_typed_rows,
    "publish_flow": q_publish_flow,
    "target_contract_violations": q_target_contract_violations,
    "wkt_vertices": q_wkt_vertices,
    "ring_orientation": q_ring_orientation,
    "polygon_area": q_polygon_area,
    "self_intersections": q_self_intersections,
    "simplify_ladder": q_simplify_ladder,
    "geography_wkb": q_geography_wkb,
    "ring_faults": q_ring_faults,
    "polar_areas": q_polar_areas,
    "valid_rungs": q_valid_rungs,
    "great_circle_significance": q_great_circle_significance,
    "large_ring_crossings": q_large_ring_crossings,
    "shape_table": q_shape_table,
    "key_violations": q_key_violations,
}


# The supplied tables each query derives its input from (for row counts in).
INPUT_TABLES = {
    **{k: ["customer"] for k in ("stage_good_rows", "stage_bad_rows", "curated_snapshot",
                                 "history_partition_overwrite", "history_empty_reload", "load_date_fallback", "incremental_stage", "area_code", "history_switch", "header_bound_scan",
                                 "null_sentinels", "wide_contract_projection", "wide_curated_rows", "wide_bad_rows",
                                 "curated_table", "publish_flow", "publish_rows", "publish_count", "typed_rows",
                                 "target_contract_violations", "shape_table", "key_violations")},
    **{k: ["supplier"] for k in ("contract_orc_scan", "strip_srid")},
    **{k: ["part"] for k in ("prefix_map", "wkt_vertices", "ring_orientation", "polygon_area",
                             "self_intersections", "simplify_ladder", "shape_rejects", "shape_decisions",
                             "geography_wkb", "ring_faults", "polar_areas", "valid_rungs", "great_circle_significance", "large_ring_crossings")},
    **{k: ["orders"] for k in ("manifest_new_inventory", "last_loaded_date", "combined_watermark",
                               "new_product_flag", "combined_new_inventory", "archive_unpack", "manifest_long_prefixes", "delivery_ledger")},
}
