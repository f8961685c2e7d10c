"""Catalog objects generated from a contract.

Column lists are never hand-written: a 619-column table is the same call
with another contract."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from terrafold.sources.contract import BAD


def ddl(schema: T.StructType, table: str, location: str | None = None, partition_by=None, fmt: str = "ORC",
        comment: str | None = None, properties: dict | None = None, drop=(BAD,)) -> str:
    """CREATE TABLE text for a contract. The partition column is
    listed last, as Spark stores it."""
    part = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    fields = [f for f in schema.fields if f.name not in drop and f.name not in part]
    fields += [f for f in schema.fields if f.name in part]
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    sql = f"CREATE TABLE {table} (\n  {cols}\n) USING {fmt}"
    if part:
        sql += f"\nPARTITIONED BY ({', '.join(part)})"
    if location:
        sql += f"\nLOCATION '{location}'"
    if comment:
        sql += "\nCOMMENT '" + comment.replace("'", "\\'") + "'"
    if properties:
        sql += "\nTBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")"
    return sql


def register(spark: SparkSession, schema: T.StructType, table: str, location: str, partition_by=None,
             fmt: str = "ORC", comment: str | None = None, properties: dict | None = None, repair: bool = True) -> None:
    """D1-D3 + S14: create the database, recreate the external table over
    ``location`` and register its existing partitions (``repair``; a table whose folder is not there yet has none)."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.split('.')[0]}")  # D1
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(ddl(schema, table, location, partition_by, fmt, comment, properties))
    if partition_by and repair:
        spark.sql(f"MSCK REPAIR TABLE {table}")


# Empty text is NULL in the curated tables (the cleaning in curate does
# the real work; this records the intent on the table).
EMPTY_AS_NULL_PROPERTIES = {"serialization.null.format": ""}
