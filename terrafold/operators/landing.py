"""Raw landing (L1 naming rules, L2 write) and the ledger of what has landed (M3, M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators.delivery import classify, file_date


def label(lines: DataFrame) -> DataFrame:
    """Add ``product`` and ``file_date`` from the archive name (L1)."""
    return lines.select(classify(F.col("archive")).alias("product"),
                        file_date(F.col("archive")).alias("file_date"), "*")


def land(lines: DataFrame, root: str, compression: str = "bzip2", rebalance: bool = True) -> None:
    """L2: write each member's lines compressed under
    ``<root>/product=<p>/file_date=<d>/member=<name>/``. Only the members
    present are replaced (dynamic overwrite), like overwriting one file.

    ``rebalance`` gathers each member's lines into few files before the
    write (Spark's REBALANCE: AQE coalesces small members together and
    splits a hot one), instead of every task writing a small file for
    every member it happened to see. Line order is not kept; TSV readers
    do not depend on it."""
    out = lines.select("product", "file_date", "member", "value")
    if rebalance:
        out = out.hint("rebalance", "product", "file_date", "member")
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("product", "file_date", "member")
        .text(root))


def land_empty(members: DataFrame, root: str) -> int:
    """L2 for members without a byte: an empty file in the member's folder, whatever it held before.
    ``members`` as :func:`label` gives them; returns how many. One small file operation each, by the driver."""
    spark = members.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    empty = members.where("bytes = 0").select("product", "file_date", "member").distinct().collect()
    for r in empty:
        folder = hadoop(f"{root}/product={r['product']}/file_date={r['file_date']}/member={r['member']}")
        files = folder.getFileSystem(conf)
        files.delete(folder, True)
        files.create(hadoop(folder, "part-empty.txt"), True).close()
    return len(empty)


LEDGER_KEYS = ("product", "file_date", "member")


def arrivals(members: DataFrame, ledger: DataFrame) -> DataFrame:
    """M3/M5 by content: each member of a drop against the ledger of landed ones (product, file_date, member, bytes, crc).

    Adds ``arrival``: ``new`` (never landed), ``changed`` (landed under this name with other content), ``renamed`` (new name, but its
    product has landed this content under another), or ``resent`` (landed as it is). Unlike the date marks, a re-sent or corrected
    file of an old date is seen. Nulls in a key match nulls. The ledger may hold several states of a member; any of them counts."""
    print_ = F.struct("bytes", "crc")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in LEDGER_KEYS]
    by_name = ledger.groupBy(*LEDGER_KEYS).agg(F.collect_set(print_).alias("_seen"))
    named = members.alias("a").join(by_name.alias("b"), same, "left").select("a.*", "b._seen")
    content = ledger.where("bytes > 0").select(F.col("product").alias("_p"), F.col("bytes").alias("_b"), F.col("crc").alias("_c")).distinct()
    both = named.join(content, F.col("product").eqNullSafe(F.col("_p")) & (F.col("bytes") == F.col("_b")) & (F.col("crc") == F.col("_c")), "left")
    arrival = (F.when(F.array_contains("_seen", print_), "resent").when(F.col("_seen").isNotNull(), "changed")
               .when(F.col("_b").isNotNull(), "renamed").otherwise("new"))
    return both.withColumn("arrival", arrival).drop("_seen", "_p", "_b", "_c")


def record(members: DataFrame, ledger_path: str) -> None:
    """Append landed members to the ledger (Parquet)."""
    members.select(*LEDGER_KEYS, "bytes", "crc").write.mode("append").parquet(ledger_path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty where nothing has been recorded yet."""
    schema = "product string, file_date string, member string, bytes long, crc long"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
