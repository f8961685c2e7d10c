"""New deliveries picked up once, with Structured Streaming (M4/M9 + S-jobs).

The reference polls: list folders, compare dates, then run the stage job.
Here a file stream over the landed tree does the bookkeeping -- its
checkpoint (in the shared folder) remembers every file already seen, so a
run with ``trigger(availableNow=True)`` sees exactly the files landed since
the last run, survives restarts and executor loss, and then stops.

Each micro-batch only tells *which delivery dates* received files (file
paths, no contents read); those dates are then re-staged in full by the
batch stage job with dynamic partition overwrite. Re-running a batch after
a failure rewrites the same partitions with the same rows, and a member
that arrives late for an already-staged date cannot wipe the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrafold.session import scratch


def new_files(spark: SparkSession, product_root: str, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of ``(file_date, member)`` for each newly landed
    file under ``<raw>/product=<p>``; contents are not read."""
    r = (spark.readStream.format("binaryFile")
         .schema("path string, modificationTime timestamp, length long, content binary")
         .option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "part-*"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    files = r.load(product_root).select("path")
    return files.select(F.regexp_extract("path", r"/file_date=([^/]+)/", 1).alias("file_date"),
                        F.regexp_extract("path", r"/member=([^/]+)/", 1).alias("member"))


def run(spark: SparkSession, raw_root: str, restage, product: str = "neighborhoods",
        checkpoint: str | None = None, prefix: str | None = None) -> list:
    """One availableNow run: restage every delivery date with new files.

    ``restage(dates)`` is the batch stage job for a list of yyyyMMdd dates
    (e.g. ``boundaries.stage_boundaries`` bound to its paths). Returns the
    dates restaged, in run order."""
    checkpoint = checkpoint or scratch(spark, f"stream-{product}")
    done: list = []

    def batch(df: DataFrame, epoch_id: int) -> None:
        if prefix:
            df = df.where(F.col("member").startswith(prefix))
        # the distinct delivery dates of one batch: a handful of values
        dates = sorted(r["file_date"] for r in df.select("file_date").distinct().collect() if r["file_date"])
        if dates:
            restage(dates)
            done.extend(dates)

    q: StreamingQuery = (new_files(spark, f"{raw_root.rstrip('/')}/product={product}")
                         .writeStream.trigger(availableNow=True)
                         .option("checkpointLocation", checkpoint)
                         .foreachBatch(batch).start())
    q.awaitTermination()
    return done
