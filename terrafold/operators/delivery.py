"""Delivery discovery over a manifest and a folder listing (M1-M9).

Everything is a small DataFrame on executors -- the manifest and the folder
listing are data, the watermark is an aggregate, the gate is a predicate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.dates import upload_day

NO_DATE = "00000000"

# The part of a manifest that is read; other keys are ignored. Declared, so
# no inference pass reads every manifest page before the real read.
MANIFEST_SCHEMA = ("result STRUCT<`last-updated`: STRING, "
                   "inventory: ARRAY<STRUCT<filename: STRING, url: STRING>>>")

# --- fixed values: product words in delivery names, first match wins --------
PRODUCT_RULES = [
    ("community-info", "community_info"),
    ("neighborhoods", "neighborhoods"),
]
# -----------------------------------------------------------------------------


def classify(name: Column, rules=PRODUCT_RULES) -> Column:
    """M6: product of a delivery name; a name with none of the words is ''."""
    expr = None
    for word, product in rules:
        expr = (F.when if expr is None else expr.when)(name.contains(word), F.lit(product))
    return expr.otherwise(F.lit(""))


def file_date(name: Column) -> Column:
    """Text before the first '-' of a delivery name (its yyyyMMdd)."""
    return F.substring_index(name, "-", 1)


def manifest(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """M1/M2: one row per inventory item with the manifest's upload day.

    A manifest is ``{"result": {"last-updated": ..., "inventory": [{filename,
    url}, ...]}}``. ``multi_line=True`` reads pretty-printed documents (one
    per file, not splittable); the default reads one document per line, so
    a paged manifest splits across tasks."""
    docs = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", str(bool(multi_line)).lower()).json(path)
    items = docs.select(
        F.col("result.`last-updated`").alias("last_updated"),
        F.inline(F.col("result.inventory")),
    )
    return items.select(
        "filename", "url", "last_updated",
        upload_day(F.col("last_updated")).alias("upload_date"),
        file_date(F.col("filename")).alias("file_date"),
        classify(F.col("filename")).alias("product"),
    )


def upload_date(manifest_df: DataFrame) -> DataFrame:
    """M2: the manifest's upload day as one row; an unparseable stamp is an
    error, not a value."""
    checked = F.coalesce(F.col("upload_date"), F.raise_error(
        F.concat(F.lit("bad last-updated: "), F.coalesce(F.col("last_updated"), F.lit("NULL")))))
    return manifest_df.agg(F.max(checked).alias("upload_date"))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Folder listing ``(product, name)`` of a landed tree: its delivery folders only, one
    glob two levels deep. Files below them are never listed, so the cost is the
    number of deliveries, not of files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/product=*/file_date=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    names = [(s.getPath().getParent().getName().split("=", 1)[1], s.getPath().getName().split("=", 1)[1])
             for s in found or [] if s.isDirectory()]
    return spark.createDataFrame(names, "product string, name string")


def _digits(c: Column) -> tuple[Column, Column]:
    """Length and text of a digit string without leading zeros: ordered as numbers of any length."""
    text = F.regexp_replace(c, "^0+(?=.)", "")
    return F.length(text), text


def _later(a: Column, b: Column) -> Column:
    """Whether digit string ``a`` is the larger number, however long they are."""
    (la, ta), (lb, tb) = _digits(a), _digits(b)
    return (la > lb) | ((la == lb) & (ta > tb))


def last_loaded(listing_df: DataFrame, by=("product",), products=None) -> DataFrame:
    """M3/M7: per product, the largest all-digit folder name compared as a
    number, returned as its original text; ``00000000`` when there is none.

    ``products`` lists products that must appear even with no folder."""
    digits = listing_df.where(F.col("name").rlike(r"^[0-9]+$"))
    agg = digits.groupBy(*by).agg(
        F.max_by("name", F.struct(*_digits(F.col("name")))).alias("last_date"))
    if products is not None and by:
        keys = listing_df.sparkSession.createDataFrame([(p,) for p in products], [by[0]])
        agg = keys.join(agg, list(by), "left")
    return agg.select(*by, F.coalesce(F.col("last_date"), F.lit(NO_DATE)).alias("last_date"))


def combined(watermarks: DataFrame) -> DataFrame:
    """M8: the larger of the products' dates (string order, as compared)."""
    return watermarks.agg(F.coalesce(F.max("last_date"), F.lit(NO_DATE)).alias("last_date"))


def gate(last_date: Column, upload: Column) -> Column:
    """M4: a newer upload exists -- string comparison of yyyyMMdd texts."""
    return last_date < upload


def new_inventory(manifest_df: DataFrame, watermarks: DataFrame, combined_mark: bool = False, products=None) -> DataFrame:
    """M5 (+M7/M8): items whose numeric name prefix is strictly after the
    watermark. Per-product watermark by default; ``combined_mark=True`` uses
    one watermark for all. A non-numeric prefix gives ``prefix_ok = false``
    instead of aborting the whole list.

    ``products`` names all products that items can have; their watermarks, one row
    each, are then broadcast, and the manifest is not shuffled."""
    if combined_mark:
        # one scalar watermark (a max over a handful of products)
        value = combined(watermarks).first()["last_date"]
        joined = manifest_df.withColumn("last_date", F.lit(value))
    elif products is not None:
        # as many rows as the list has names, whatever the listing holds
        marks = last_of(watermarks, products)
        joined = manifest_df.join(F.broadcast(marks), "product", "left")
    else:
        # one row per product. No broadcast hint: AQE sees the aggregate's
        # real size at run time and broadcasts it only under its threshold.
        joined = manifest_df.join(watermarks.select("product", "last_date"), "product", "left")
    mark = F.coalesce(F.col("last_date"), F.lit(NO_DATE))
    numeric = F.coalesce(F.col("file_date").rlike("^[0-9]+$"), F.lit(False))
    return joined.select(
        *manifest_df.columns,
        mark.alias("last_date"),
        numeric.alias("prefix_ok"),
        F.when(numeric, _later(F.col("file_date"), mark)).alias("is_new"),
    )


def last_of(watermarks: DataFrame, products) -> DataFrame:
    """The watermarks of the listed products, at most one row for each."""
    return watermarks.where(F.col("product").isin(list(products))).groupBy("product").agg(F.max("last_date").alias("last_date"))


def new_product_flags(inventory: DataFrame, products=("neighborhoods", "community_info")) -> DataFrame:
    """M9: per product, true iff any new item classifies to it."""
    keys = inventory.sparkSession.createDataFrame([(p,) for p in products], ["product"])
    flags = (inventory.where(F.col("is_new")).groupBy("product")
             .agg(F.lit(True).alias("has_new")))
    return (keys.join(flags, "product", "left")
            .select("product", F.coalesce("has_new", F.lit(False)).alias("has_new")))
