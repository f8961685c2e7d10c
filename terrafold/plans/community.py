"""The wide demographic product end to end: land -> stage -> curate.

Same operators as the boundaries product with another contract; nothing
here names a column. The vendor's contract is a JSON file
(``contract.load``); ``derive.wide_contract`` makes up one for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrafold.operators import curate, stage
from terrafold.plans import catalog
from terrafold.sources.contract import BAD, snapshot_contract, stage_contract
from terrafold.sources.delimited import scan_landing

PRODUCT = "community_info"
PREFIX = "community"


def stage_community(spark: SparkSession, raw_root: str, contract: T.StructType, history: str,
                    bad: str | None = None, days=None, load_date=None) -> dict:
    """Stage job: contracted scan of the landed drop(s), stamp (no lineage
    labels for this product), good/bad split in one pass over the wide lines, history by load date."""
    parsed = scan_landing(spark, f"{raw_root}/product={PRODUCT}", contract, prefix=PREFIX, dates=days)
    return stage.run(spark, parsed, history, bad, load_date=load_date, contract=contract, strategy="once")


def curate_community(spark: SparkSession, history: str, contract: T.StructType, out: str | None = None,
                     dates=None) -> DataFrame:
    """Curate job: contracted history scan, audit columns dropped, restamp
    (for this product the whole transform)."""
    snap = curate.snapshot(curate.scan(spark, history, stage_contract(contract, lineage=()), dates))
    if out is None:
        return snap
    curate.write(snap, out)
    return spark.read.orc(out)


def register_community(spark: SparkSession, contract: T.StructType, history: str, curated: str,
                       history_table: str, curated_table: str) -> None:
    """The history (partitioned by load date) and the curated snapshot as external tables."""
    catalog.register(spark, stage_contract(contract, lineage=()), history_table, history, partition_by="load_date")
    catalog.register(spark, snapshot_contract(contract, lineage=()), curated_table, curated,
                     properties=catalog.EMPTY_AS_NULL_PROPERTIES)


def row_hashes(df: DataFrame, key: str, contract: T.StructType) -> DataFrame:
    """``(key, row_hash)``: md5 of every column as text in contract order, tab between (NULL: empty)."""
    from terrafold.functions import sqltext

    cells = ", ".join(f"coalesce(CAST({sqltext.ident(f.name)} AS STRING), '')" for f in contract.fields if f.name != BAD)
    return df.selectExpr(f"{sqltext.ident(key)} AS row_key", f"md5(concat_ws('\t', {cells})) AS row_hash")


def column_totals(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Per-column totals, unpivoted to ``(column_name, total)``: numeric
    columns summed exactly as decimal(38,4), text columns by length. One
    aggregate (partial per task, one row per task to the shuffle)."""
    from terrafold.functions import sqltext

    names = [f.name for f in contract.fields if f.name != BAD]
    sums = []
    for f in contract.fields:
        if f.name == BAD:
            continue
        v = f"length({sqltext.ident(f.name)})" if isinstance(f.dataType, T.StringType) else sqltext.ident(f.name)
        sums.append(f"CAST(CAST(sum({v}) AS DECIMAL(38,4)) AS STRING) AS {sqltext.ident(f.name)}")
    totals = df.selectExpr(*sums)
    pairs = ", ".join(f"{sqltext.lit(n)}, {sqltext.ident(n)}" for n in names)
    return totals.selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, total)")
