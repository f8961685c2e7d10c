"""Publish to a warehouse table.

The target is either a JDBC table (``write.jdbc``/``read.jdbc``) or a table
in Spark's catalog. The contract of the target is checked *before* the
load (P4), so rows the database would refuse are listed instead of failing
the export half way.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terrafold.functions import geo


@dataclass(frozen=True)
class Rule:
    column: str
    max_length: int | None = None
    nullable: bool = True
    decimal: tuple[int, int] | None = None


# --- fixed values: the landing table's contract (text limits, NOT NULL) -------
LANDING_RULES = [
    Rule("geo_type", 18, nullable=False),
    Rule("neighborhood_type", 20, nullable=False),
    Rule("geo_id", 32, nullable=False),
    Rule("name", 200),
    Rule("fips_code", 5),
    Rule("state_abbr", 2),
    Rule("state_fips_code", 2),
    Rule("metro", 200),
    Rule("incorporated_place", 200),
    Rule("county", 100),
    Rule("county_fips_code", 3),
    Rule("longitude", decimal=(9, 6)),
    Rule("latitude", decimal=(9, 6)),
]
# The typed table additionally requires an area code.
TYPED_RULES = [r if r.column != "fips_code" else Rule("fips_code", 5, nullable=False) for r in LANDING_RULES]
# Columns exported, in order; the created stamp is left to the target default.
EXPORT_COLUMNS = ["geo_type", "neighborhood_type", "geo_id", "name", "fips_code", "state_abbr", "state_fips_code",
                  "metro", "incorporated_place", "county", "county_fips_code", "longitude", "latitude", "geoloc"]
# -----------------------------------------------------------------------------


def _failures(rules):
    checks = []
    for r in rules:
        c = F.col(r.column)
        if r.max_length is not None:
            checks.append(F.when(F.length(c) > r.max_length,
                                 F.struct(F.lit(r.column).alias("column"), F.lit(f"length>{r.max_length}").alias("rule"))))
        if not r.nullable:
            checks.append(F.when(c.isNull(), F.struct(F.lit(r.column).alias("column"), F.lit("not null").alias("rule"))))
        if r.decimal is not None:
            p, s = r.decimal
            checks.append(F.when(c.isNotNull() & c.try_cast(f"decimal({p},{s})").isNull(),
                                 F.struct(F.lit(r.column).alias("column"), F.lit(f"decimal({p},{s})").alias("rule"))))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def violations(df: DataFrame, rules=LANDING_RULES, key=("geo_id",)) -> DataFrame:
    """One row ``(key.., column, rule)`` per broken rule. Narrow: each
    row builds its own small array of failures and explodes it."""
    key = [key] if isinstance(key, str) else list(key)
    return (df.select(*key, F.explode(_failures(rules)).alias("_v"))
              .select(*key, F.col("_v.column").alias("column"), F.col("_v.rule").alias("rule")))


def split_violations(df: DataFrame, rules=LANDING_RULES):
    """P4 before a load: ``(rows that meet the contract, rows that do not)``
    -- the second keeps every column plus the list of broken rules, so
    nothing is silently dropped."""
    flagged = df.withColumn("_violations", _failures(rules))
    ok = flagged.where(F.size("_violations") == 0).drop("_violations")
    bad = flagged.where(F.size("_violations") > 0).withColumnRenamed("_violations", "violations")
    return ok, bad


def export(df: DataFrame, columns=EXPORT_COLUMNS) -> DataFrame:
    """The column-listed export projection."""
    return df.select(*columns)


def load_table(df: DataFrame, table: str, columns=EXPORT_COLUMNS, validate: bool = True) -> int:
    """P1-P3 into a catalog table: truncate-then-load (``INSERT OVERWRITE``
    with a column list, so omitted columns take the table's DEFAULT), then
    compare row counts. The source rows are counted while they are written
    (``DataFrame.observe``), so validation costs no second pass over the
    source. Returns the loaded row count."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:8]
    obs = Observation(f"publish_{tag}")
    view = f"_publish_src_{tag}"
    export(df, columns).observe(obs, F.count(F.lit(1)).alias("n")).createOrReplaceTempView(view)
    try:
        cols = ", ".join(columns)
        spark.sql(f"INSERT OVERWRITE TABLE {table} ({cols}) SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    if not validate:
        return -1
    return validate_count(None, spark.table(table), source_count=obs.get.get("n", 0))


def load_jdbc(df: DataFrame, url: str, table: str, columns=EXPORT_COLUMNS, writers: int = 2,
              properties: dict | None = None, validate: bool = True) -> int:
    """P1-P3 over JDBC: truncate (keeps the target's DDL and defaults), load
    with at most ``writers`` connections, read the count back. Not exercised
    by the tests: no database server is started here."""
    props = {"truncate": "true", "numPartitions": str(writers), **(properties or {})}
    obs = Observation(f"jdbc_{uuid.uuid4().hex[:8]}")
    rows = export(df, columns).observe(obs, F.count(F.lit(1)).alias("n"))
    # numPartitions alone would coalesce, and run all of the upstream job in that many tasks
    rows.repartition(writers).write.jdbc(url, table, mode="overwrite", properties=props)
    if not validate:
        return -1
    target = df.sparkSession.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}) t", properties=properties or {})
    return validate_count(None, None, target_count=int(target.first()["n"]), source_count=obs.get.get("n", 0))


def validate_count(source: DataFrame | None, target: DataFrame | None, target_count: int | None = None,
                   source_count: int | None = None) -> int:
    """Source and target row counts must agree."""
    src = source.count() if source_count is None else source_count
    tgt = target.count() if target_count is None else target_count
    if src != tgt:
        raise RuntimeError(f"row count mismatch: source {src}, target {tgt}")
    return tgt


def typed(df: DataFrame, wkt: str = "geoloc") -> DataFrame:
    """P5: landing rows -> typed rows: fresh stamp, decimals typed, the WKT
    parsed into a shape (rows that do not parse keep a NULL shape)."""
    from terrafold.operators.geometry import once

    base = df.select(
        F.current_timestamp().alias("created_datetime"),
        *[F.col(c) for c in EXPORT_COLUMNS if c not in ("longitude", "latitude", wkt)],
        F.col("longitude").cast("decimal(9,6)").alias("longitude"),
        F.col("latitude").cast("decimal(9,6)").alias("latitude"),
        F.col(wkt),
    )
    parsed = once(base, shape=geo.parse_wkt(geo.col(wkt)))
    parsed = once(parsed, _problem=geo.wkt_problem(geo.col(wkt), "shape"))
    return parsed.withColumn("shape", F.when(F.col("_problem").isNull(), F.col("shape"))).drop("_problem")
