"""Schema contracts.

A contract is a Spark ``StructType`` saved as JSON. Source columns are
renamed by position; the vendor's own name survives as field metadata
``original_name``. The reader never infers a schema at the raw edge.
"""

from __future__ import annotations

import json
import pkgutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BAD = "_bad_data"


def from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def load(path: str, spark: SparkSession | None = None) -> T.StructType:
    """Contract JSON -> StructType, metadata kept.

    With a session the file (or the folder :func:`save` wrote) is read through
    Spark's file layer as one small whole-text record, from any store Spark
    knows; without one, from the driver's disk."""
    if spark is not None:
        return from_json(spark.read.text(path, wholetext=True).where("trim(value) <> ''").first()[0])
    with open(path[5:] if path.startswith("file:") else path) as fh:
        return from_json(fh.read())


def save(schema: T.StructType, path: str, spark: SparkSession | None = None) -> str:
    """The contract as JSON: a file, or with a session a folder of one text file."""
    if spark is not None:
        one = spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string").coalesce(1)
        one.write.mode("overwrite").text(path)
        return path
    with open(path[5:] if path.startswith("file:") else path, "w") as fh:
        fh.write(json.dumps(schema.jsonValue(), indent=2))
    return path


def require(df: DataFrame, names) -> DataFrame:
    """Fail early when a lineage or contract column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}; have {df.columns}")
    return df


def with_bad_column(schema: T.StructType, bad: str = BAD) -> T.StructType:
    """Append the reserved malformed-line column when the contract lacks it."""
    if bad in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(bad, T.StringType(), True)])


def without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


def shipped(name: str) -> T.StructType:
    """A contract of the package's ``contracts`` folder (also from the zip the executors get)."""
    return from_json(pkgutil.get_data("terrafold", f"contracts/{name}.json").decode())


# The boundaries product: raw TSV columns in file order with the vendor's names as
# metadata, and the read contract of its stage history (fips_code is filled by curate).
NEIGHBORHOODS_RAW = shipped("neighborhoods_raw")
NEIGHBORHOODS_STAGE = shipped("neighborhoods_stage")


def stage_contract(raw: T.StructType, lineage=("geo_type",), bad: str = BAD) -> T.StructType:
    """Read contract of a stage history derived from its raw contract:
    created stamp, lineage labels, the raw columns, then load_date and the
    bad-row column (the layout :func:`terrafold.operators.stage.stamp`
    writes, with the partition column last as Spark reads it back)."""
    cols = [T.StructField("created_datetime", T.TimestampType(), True)]
    cols += [T.StructField(n, T.StringType(), True) for n in lineage]
    cols += [f for f in raw.fields if f.name != bad and f.name not in lineage]
    cols += [T.StructField("load_date", T.DateType(), True), T.StructField(bad, T.StringType(), True)]
    return T.StructType(cols)


def snapshot_contract(raw: T.StructType, lineage=("geo_type",), bad: str = BAD) -> T.StructType:
    """Contract of the curated snapshot: the stage history's without its load date and bad-row column."""
    return without(stage_contract(raw, lineage, bad), "load_date", bad)
