"""Stage: stamp, split good from bad rows, write history."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import sqltext
from terrafold.sources.contract import BAD, require

LINEAGE = ("file_name", "parent_folder_name")
log = logging.getLogger(__name__)


def stamp(df: DataFrame, load_date: dt.date | str | None = None, labels=(), label_from: str = "file_name",
          contract=None, keep_lineage: bool = True, bad: str = BAD, run_date: dt.date | str | None = None) -> DataFrame:
    """Created stamp, load date, label columns copied from the source
    file name, then the contract columns in contract order -- one select,
    whatever the width (as SQL text: a 620-column projection is
    one call, not 620 Column objects).

    ``load_date=None`` takes each row's date from its dated folder, so one
    scan over many drops stamps each row with its own delivery date. A
    folder that is no date gives ``run_date``, else the UTC date of now (S7)."""
    if labels or keep_lineage:
        require(df, LINEAGE)  # S6
    if load_date is not None:
        ld = f"CAST({sqltext.lit(str(load_date))} AS DATE)"
    else:
        day = run_date or dt.datetime.now(dt.timezone.utc).date()
        ld = (f"coalesce(CAST(CASE WHEN parent_folder_name RLIKE '^[0-9]{{8}}$' THEN try_to_timestamp(parent_folder_name, 'yyyyMMdd') END AS DATE), "
              f"CAST({sqltext.lit(str(day))} AS DATE))")
    data_cols = [c for c in (contract.fieldNames() if contract is not None else df.columns)
                 if c not in LINEAGE and c != bad]
    cols = ["current_timestamp() AS created_datetime", f"{ld} AS load_date"]
    cols += [f"{sqltext.ident(label_from)} AS {sqltext.ident(n)}" for n in labels]
    cols += [sqltext.ident(c) for c in data_cols if c not in labels]
    if bad in df.columns:
        cols.append(sqltext.ident(bad))
    if keep_lineage:
        cols += [sqltext.ident(c) for c in LINEAGE]
    return df.selectExpr(*cols)


def split(df: DataFrame, bad: str = BAD, storage: StorageLevel = StorageLevel.MEMORY_AND_DISK, bad_by=None,
          strategy: str = "reparse"):
    """Good rows (bad column dropped) and bad rows (the raw line).

    Returns ``(good, bad, parsed)``; call ``parsed.unpersist()`` after both
    writes when it is not None.

    * ``reparse`` (default): each output scans the raw text; nothing is held.
    * ``persist``: one full-width parse, persisted on the executors, feeds both
      outputs. For a drop known to fit there.

    Either way every row is parsed at full width, so column pruning cannot
    shrink the parse to columns that always parse cleanly and hide
    malformed rows (S4): the good side needs every column anyway, and the
    bad side keeps them all required through a zero-length slice of the
    row (the result is the raw line unchanged)."""
    if strategy not in ("persist", "reparse"):
        raise ValueError(f"unknown split strategy {strategy!r}")
    parsed = df.persist(storage) if strategy == "persist" else df
    good = parsed.where(F.col(bad).isNull()).drop(bad)
    others = [F.col(c).cast("string") for c in parsed.columns if c != bad]
    anchor = F.substring(F.concat_ws("", *others), 1, 0)
    bad_rows = parsed.where(F.col(bad).isNotNull()).select(
        F.concat(F.col(bad), anchor).alias(bad), *([bad_by] if bad_by else []))
    return good, bad_rows, (parsed if strategy == "persist" else None)


def write_history(df: DataFrame, path: str, by: str = "load_date", compression: str = "snappy", observe=(), gather: bool = True) -> None:
    """ORC history partitioned by load date. Dynamic overwrite
    replaces only the dates present in ``df``; other dates stay. The rebalance
    gathers a date's rows into few files; AQE splits a large date. Rows of one given date (``gather`` false) make
    a file per task without it, and need no shuffle. ``observe`` (an
    observation and its metrics) sits above it: AQE drops what is below an empty shuffle."""
    if gather:
        df = df.hint("rebalance", by)
    if observe:
        df = df.observe(*observe)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(by)
       .orc(path))


def write_bad(df: DataFrame, path: str, by: str | None = None) -> None:
    """Malformed lines as plain, uncompressed text. With ``by`` (the
    delivery folder) each delivery's bad lines replace only its own folder,
    so re-staging one date is idempotent."""
    w = df.write.mode("overwrite").option("compression", "none")
    if by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(by)
    w.text(path)


def register(spark: SparkSession, table: str, dates=None) -> None:
    """Make newly written partitions visible in the catalog: those of ``dates``, or
    whatever a listing of the whole table finds when they are not known."""
    if dates is None:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    elif dates:
        parts = " ".join(f"PARTITION (load_date = DATE '{d}')" for d in dates)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def run(spark: SparkSession, parsed: DataFrame, history_path: str, bad_path: str | None = None,
        load_date=None, labels=(), contract=None, table: str | None = None, bad: str = BAD,
        bad_by: str | None = None, strategy: str = "reparse", reload_dates=(), run_date=None) -> dict:
    """The stage job: stamp -> split -> bad sink -> history sink -> repair.

    ``reload_dates`` are the load dates this run replaces: one that turns out
    to have no good row is removed from the history, so withdrawn rows do not
    stay (S13). Bad rows are counted even where no sink is given.

    With the strategy ``once`` the text is parsed once: see :func:`_once`; the others are those of :func:`split`.

    Row counts are observed while the sinks write (``DataFrame.observe``),
    so counting costs no extra pass."""
    stamped = stamp(parsed, load_date, labels=labels, contract=contract, bad=bad, run_date=run_date)
    days = sorted({str(d) for d in reload_dates})
    if strategy == "once":
        counts, per_day = _once(spark, stamped, history_path, bad_path, bad, bad_by, days, gather=load_date is None)
        return _settled(spark, history_path, bad_path, table, counts, per_day)
    good, bad_rows, cached = split(stamped, bad, bad_by=bad_by, strategy=strategy)
    tag = uuid.uuid4().hex[:8]  # observation names must not collide across concurrent jobs
    good_obs, bad_obs = Observation(f"stage_good_{tag}"), Observation(f"stage_bad_{tag}")
    counts = [F.count(F.lit(1)).alias("n"),
              *[F.count_if(F.col("load_date") == F.lit(d).cast("date")).alias(f"d{i}") for i, d in enumerate(days)]]
    bad_rows = bad_rows.observe(bad_obs, F.count(F.lit(1)).alias("n"))
    try:
        if bad_path:
            write_bad(bad_rows, bad_path, by=bad_by)
        else:  # parsed at full width and counted, kept nowhere
            bad_rows.write.format("noop").mode("overwrite").save()
        n_bad = bad_obs.get.get("n", 0)
        write_history(good, history_path, observe=(good_obs, *counts), gather=load_date is None)
    finally:
        if cached is not None:
            cached.unpersist()
    per_day = {d: good_obs.get.get(f"d{i}", 0) for i, d in enumerate(days)}
    return _settled(spark, history_path, bad_path, table, {"good": good_obs.get.get("n", 0), "bad": n_bad}, per_day)


def _settled(spark: SparkSession, history_path: str, bad_path: str | None, table: str | None, counts: dict, per_day: dict) -> dict:
    """What follows the writes: dates without a good row go from the history, the others into the catalog."""
    if counts["bad"] and not bad_path:
        log.warning("%d malformed lines and no folder to keep them in", counts["bad"])
    for d, n in per_day.items():
        if not n:
            _remove(spark, f"{history_path}/load_date={d}")
            if table:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load_date = DATE '{d}')")
    if table:
        known = sum(per_day.values()) == counts["good"]  # else rows took the run's date
        register(spark, table, [d for d, n in per_day.items() if n] if known else None)
    return counts


def _once(spark: SparkSession, stamped: DataFrame, history_path: str, bad_path: str | None, bad: str, bad_by: str | None, days: list[str], gather: bool):
    """S10-S13 with one pass over the text, for lines that are dear to parse. One job writes good and bad rows apart, into a hidden folder of
    the history; the bad lines go on to their sink, then the folders of the dates are put in place, as a dynamic overwrite does.
    The files of the history hold the (empty) bad column, too. Returns the counts, and the good rows by day."""
    run_path = f"{history_path}/_run-{uuid.uuid4().hex[:12]}"
    is_bad = F.col(bad).isNotNull()
    seen = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    both = stamped.withColumn("outcome", F.when(is_bad, "bad").otherwise("good"))
    if gather:
        both = both.hint("rebalance", "outcome", "load_date")
    both = both.observe(seen, F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("bad"),
                        *[F.count_if(~is_bad & (F.col("load_date") == F.lit(d).cast("date"))).alias(f"d{i}") for i, d in enumerate(days)])
    both.write.option("compression", "snappy").partitionBy("outcome", "load_date").orc(run_path)
    counts = {"good": seen.get.get("good", 0), "bad": seen.get.get("bad", 0)}
    if bad_path:
        write_bad(_bad_lines(spark, f"{run_path}/outcome=bad", bad, bad_by, counts["bad"]), bad_path, by=bad_by)
    for name in _names(spark, f"{run_path}/outcome=good"):
        if name.startswith("load_date="):
            _remove(spark, f"{history_path}/{name}")
            _move(spark, f"{run_path}/outcome=good/{name}", f"{history_path}/{name}")
    _remove(spark, run_path)
    return counts, {d: seen.get.get(f"d{i}", 0) for i, d in enumerate(days)}


def _bad_lines(spark: SparkSession, folder: str, bad: str, bad_by: str | None, count: int) -> DataFrame:
    names = [bad, *([bad_by] if bad_by else [])]
    fields = ", ".join(f"`{n}` string" for n in names)
    lines = spark.read.schema(fields).orc(folder) if count else spark.createDataFrame([], fields)
    return lines.select(*names)


def reload(spark: SparkSession, parsed: DataFrame, table: str, runs: str, bad_path: str | None = None, load_date=None, labels=(),
           contract=None, bad: str = BAD, bad_by: str | None = None, reload_dates=(), run_date=None) -> dict:
    """The stage job into a catalog table, in one pass over the text and without a moment in which a date is half replaced.

    One job parses the text once and writes both outcomes to a folder of this run below ``runs``: good rows by load date, bad lines
    beside them. The bad lines, few, go on to their sink. Only then does each date of ``table``
    change over, by one catalog statement that points its partition to the new files; a date of ``reload_dates`` without a good row
    is dropped. A run that fails before leaves the table's rows as they were, and readers of the old files finish on them:
    old run folders stay until somebody deletes them."""
    stamped = stamp(parsed, load_date, labels=labels, contract=contract, bad=bad, run_date=run_date)
    days = sorted({str(d) for d in reload_dates})
    run_path = f"{runs}/run-{uuid.uuid4().hex[:12]}"
    is_bad = F.col(bad).isNotNull()
    kept = {bad, "load_date", bad_by}
    both = stamped.select(*[F.col(c) if c in kept else F.when(~is_bad, F.col(c)).alias(c) for c in stamped.columns],
                          F.when(is_bad, "bad").otherwise("good").alias("outcome"))
    seen = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    both = both.hint("rebalance", "outcome", "load_date").observe(seen, F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("bad"))
    both.write.option("compression", "snappy").partitionBy("outcome", "load_date").orc(run_path)
    counts = {"good": seen.get.get("good", 0), "bad": seen.get.get("bad", 0)}
    if bad_path:
        write_bad(_bad_lines(spark, f"{run_path}/outcome=bad", bad, bad_by, counts["bad"]), bad_path, by=bad_by)
    elif counts["bad"]:
        log.warning("%d malformed lines and no folder to keep them in", counts["bad"])
    switch(spark, table, f"{run_path}/outcome=good", days)
    return counts


def switch(spark: SparkSession, table: str, folder: str, dates=()) -> None:
    """Point the partitions of the load dates found in ``folder`` to it; other ``dates`` are dropped."""
    new = {n.split("=", 1)[1] for n in _names(spark, folder) if n.startswith("load_date=")}
    for d in sorted(new):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (load_date = DATE '{d}') LOCATION '{folder}/load_date={d}'")
        spark.sql(f"ALTER TABLE {table} PARTITION (load_date = DATE '{d}') SET LOCATION '{folder}/load_date={d}'")
    for d in sorted(set(map(str, dates)) - new):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load_date = DATE '{d}')")
    spark.catalog.refreshTable(table)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of whatever file system; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is on; nothing if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _move(spark: SparkSession, folder: str, to: str) -> None:
    """Rename a folder within its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(folder), path(to)):
        raise OSError(f"{folder} could not be moved to {to}")
