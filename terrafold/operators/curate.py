"""Curate: contracted history scan, cleaning, restamp, snapshot."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import clean, sqltext
from terrafold.sources.contract import BAD

AUDIT = ("created_datetime", "load_date", BAD)


def scan(spark: SparkSession, path: str, schema=None, dates=None) -> DataFrame:
    """Read ORC by contract -- missing columns are NULL, extra columns
    (lineage) are dropped, the partition column is typed. ``dates`` narrows
    to some load dates through partition pruning."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.orc(path)
    if dates is not None:
        df = df.where(F.col("load_date").isin([F.lit(str(d)).cast("date") for d in dates]))
    return df


def latest_dates(spark: SparkSession, table: str, n: int = 1) -> list:
    """The ``n`` most recent load dates of a registered history table, read
    from the catalog's partition list (``SHOW PARTITIONS``): no data file is
    opened, so curating the newest delivery does not scan the history."""
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    days = sorted({p.split("=", 1)[1] for p in parts if p.startswith("load_date=")})
    return days[-n:] if n else days


def drop_audit(df: DataFrame, cols=AUDIT) -> DataFrame:
    """Drop stage audit columns; absent names are ignored."""
    return df.drop(*cols)


def restamp(df: DataFrame, name: str = "created_datetime") -> DataFrame:
    """A fresh created stamp first, then every column."""
    return df.selectExpr(f"current_timestamp() AS {sqltext.ident(name)}",
                         *[sqltext.ident(c) for c in df.columns if c != name])


def clean_neighborhoods(df: DataFrame, geo_rules=clean.GEO_TYPE_RULES,
                        type_rules=clean.NEIGHBORHOOD_TYPE_RULES) -> DataFrame:
    """C3-C9 as one projection, keeping the contract's column order."""
    codes = dict(clean.PADDED_CODES)
    (sa, sw), (ca, cw) = clean.PADDED_CODES
    exprs = {
        "geo_type": clean.prefix_map("geo_type", geo_rules),
        "neighborhood_type": clean.prefix_map("neighborhood_type", type_rules),
        "fips_code": clean.area_code(sa, sw, ca, cw),
        "geoloc": clean.strip_srid("geoloc"),
    }
    for c in clean.EMPTY_AS_NULL:
        exprs[c] = clean.nullif(c, "")
    for c in clean.ZERO_AS_NULL:
        exprs[c] = clean.nullif(c, 0)
    for c, w in codes.items():
        exprs[c] = clean.pad_code(c, w)
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def snapshot(df: DataFrame, steps=(), drop=AUDIT) -> DataFrame:
    """Drop audit columns, apply ``steps`` with ``DataFrame.transform``,
    restamp. For the wide product ``steps`` is empty: curate = restamp."""
    out = drop_audit(df, drop)
    for step in steps:
        out = out.transform(step)
    return restamp(out)


def write(df: DataFrame, path: str) -> None:
    """C11: unpartitioned ORC snapshot, overwritten."""
    df.write.mode("overwrite").orc(path)


def replace(df: DataFrame, table: str, runs: str) -> str:
    """C11 without a gap: the snapshot is written to a folder of its own below ``runs``, then one catalog statement points the
    external ``table`` there. A job that fails before leaves the old snapshot readable. Returns the folder."""
    path = f"{runs}/run-{uuid.uuid4().hex[:12]}"
    write(df, path)
    spark = df.sparkSession
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return path
