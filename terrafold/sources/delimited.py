"""Contracted delimited-text scan.

Two layouts are read:

* vendor layout -- ``<root>/<yyyyMMdd>/<product>*.tsv[.bz2]``, files named by
  the vendor (``scan_folder``);
* landed layout -- what :func:`terrafold.operators.landing.land` writes:
  ``<root>/file_date=<yyyyMMdd>/member=<name>/part-*`` (``scan_landing``).
  The member name lives in a partition column because Spark picks part-file
  names, and selecting members or dates becomes partition pruning.

In the vendor layout a file may also bind its columns by its own header line (``scan_headed``).

All read with a declared schema (never inferred), tab separator, both-side
trim and PERMISSIVE mode with an explicit corrupt-record column, so a row
with a wrong field count, a value that does not fit its type, or a header
line is captured whole in ``_bad_data``. bz2 input is splittable.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.sources.contract import BAD, with_bad_column


def _reader(spark: SparkSession, schema: T.StructType, bad: str, header: bool, sep: str):
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", str(bool(header)).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad)
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
    )


def scan_folder(spark: SparkSession, folder: str, schema: T.StructType, prefix: str = "",
                bad: str = BAD, header: bool = False, sep: str = "\t") -> DataFrame:
    """S2/S3/S5 over one vendor-layout folder (or a glob of folders)."""
    schema = with_bad_column(schema, bad)
    df = _reader(spark, schema, bad, header, sep).csv(f"{folder.rstrip('/')}/{prefix}*")
    return df.select("*", *_lineage())


def _lineage():
    """A file's name and its folder's."""
    path = F.col("_metadata.file_path")
    return (F.regexp_extract(path, r"^(.*/)(.+)$", 2).alias("file_name"),
            F.regexp_extract(path, r"^(.*/)?([^/]*)/[^/]*$", 2).alias("parent_folder_name"))


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first line of each file; a few bytes of it are read."""
    from pyarrow import fs

    for pdf in batches:
        lines = []
        for uri in pdf["path"]:
            filesystem, inner = fs.FileSystem.from_uri(uri)
            with filesystem.open_input_stream(inner, compression="detect", buffer_size=1 << 16) as f:
                got = b""
                while b"\n" not in got and (piece := f.read(1 << 14)):
                    got += piece
            lines.append(got.split(b"\n")[0].decode("utf-8", "replace").rstrip("\r"))
        yield pd.DataFrame({"path": pdf["path"], "line": lines})


def headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """First line of every file, read on the executors; one short text per file comes back."""
    if not files:
        return {}
    n = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    paths = spark.createDataFrame([(f if "://" in f or f.startswith("file:") else os.path.abspath(f),) for f in files], "path string").repartition(n)
    return {r["path"]: r["line"] for r in paths.mapInPandas(_first_lines, "path string, line string").collect()}


def column_order(header: str, schema: T.StructType, sep: str = "\t") -> list[str] | None:
    """The contract's columns in the order a header line names them (by vendor name, else by column name; case and outer
    blanks do not matter), or None unless it names each exactly once and nothing else."""
    known = {str(f.metadata.get("original_name", f.name)).strip().lower(): f.name for f in schema.fields}
    named = [known.get(h.strip().strip('"').lower()) for h in header.split(sep)]
    return named if sorted(map(str, named)) == sorted(schema.fieldNames()) else None


def scan_headed(spark: SparkSession, folder: str, schema: T.StructType, prefix: str = "", bad: str = BAD, sep: str = "\t") -> DataFrame:
    """:func:`scan_folder` for files that start with a header line, which binds that file's columns to the contract by name, in
    whatever order. Files are read together with all others of their order. A file whose header
    is not the contract's columns cannot be typed: each of its lines, the first too, is a bad row. Column order and
    lineage columns of the result are those of :func:`scan_folder`."""
    schema = T.StructType([f for f in schema.fields if f.name != bad])
    source = f"{folder.rstrip('/')}/{prefix}*"
    orders = defaultdict(list)
    for path, line in headers(spark, spark.read.text(source).inputFiles()).items():
        orders[tuple(column_order(line, schema, sep) or ())].append(unquote(path))
    full = with_bad_column(schema, bad)
    out = []
    for order, files in sorted(orders.items()):
        if order:
            permuted = T.StructType([schema[n] for n in order] + [full[bad]])
            df = _reader(spark, permuted, bad, True, sep).csv(sorted(files))
            out.append(df.select(*full.fieldNames(), *_lineage()))
        else:
            df = spark.read.text(sorted(files))
            out.append(df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.col("value").alias(bad), *_lineage()))
    if not out:
        lineage = T.StructType(full.fields + [T.StructField(n, T.StringType()) for n in ("file_name", "parent_folder_name")])
        return spark.createDataFrame([], lineage)
    return reduce(DataFrame.unionByName, out)


def scan_landing(spark: SparkSession, root: str, schema: T.StructType, prefix: str = "",
                 dates=None, bad: str = BAD, header: bool = False, sep: str = "\t") -> DataFrame:
    """S2/S3/S5 over a landed product folder; ``dates`` (yyyyMMdd strings)
    and ``prefix`` prune partitions before any file is opened."""
    schema = with_bad_column(schema, bad)
    full = T.StructType(list(schema.fields) + [
        T.StructField("file_date", T.StringType(), True),
        T.StructField("member", T.StringType(), True),
    ])
    df = _reader(spark, full, bad, header, sep).option("basePath", root).csv(root)
    if prefix:
        df = df.where(F.col("member").startswith(prefix))
    if dates is not None:
        df = df.where(F.col("file_date").isin(list(dates)))
    return df.withColumnRenamed("member", "file_name").withColumnRenamed("file_date", "parent_folder_name")
