"""The boundaries product end to end: land -> stage -> curate -> publish
-> shapes, each step a DataFrame job over the previous step's output."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from terrafold.operators import curate, geometry, landing, publish, stage
from terrafold.plans import derive
from terrafold.session import apply_job_conf, scratch, tasks_for
from terrafold.sources.contract import NEIGHBORHOODS_RAW, NEIGHBORHOODS_STAGE
from terrafold.sources.delimited import scan_landing

LABELS = ("geo_type", "neighborhood_type")


def stage_boundaries(spark: SparkSession, raw_root: str, history: str, bad: str | None = None, days=None,
                     load_date=None, table: str | None = None, bad_by: str | None = None, run_date=None) -> dict:
    """Stage job over landed boundary files (one or many delivery days); the
    given days are replaced, also by nothing."""
    parsed = scan_landing(spark, f"{raw_root}/product=neighborhoods", NEIGHBORHOODS_RAW,
                          prefix="neighborhoods", dates=days)
    return stage.run(spark, parsed, history, bad, load_date=load_date, labels=LABELS,
                     contract=NEIGHBORHOODS_RAW, table=table, bad_by=bad_by, reload_dates=_dates(days, load_date), run_date=run_date)


def reload_boundaries(spark: SparkSession, raw_root: str, table: str, runs: str, bad: str | None = None, days=None, load_date=None,
                      bad_by: str | None = None, run_date=None) -> dict:
    """:func:`stage_boundaries` into a catalog table whose dates change over by location, with one pass over the text."""
    parsed = scan_landing(spark, f"{raw_root}/product=neighborhoods", NEIGHBORHOODS_RAW, prefix="neighborhoods", dates=days)
    return stage.reload(spark, parsed, table, runs, bad, load_date=load_date, labels=LABELS, contract=NEIGHBORHOODS_RAW, bad_by=bad_by,
                        reload_dates=_dates(days, load_date), run_date=run_date)


def _dates(days, load_date) -> list[str]:
    """Load dates of delivery folders: the given one, else those folder names that are dates."""
    if load_date is not None:
        return [str(load_date)]
    out = []
    for d in days or []:
        try:
            out.append(str(dt.datetime.strptime(str(d), "%Y%m%d").date()))
        except ValueError:
            pass
    return out


def curate_boundaries(spark: SparkSession, history: str, out: str | None = None, dates=None) -> DataFrame:
    """Curate job: contracted scan of the history, clean, restamp; written
    to ``out`` (ORC, overwrite) and read back when ``out`` is given."""
    df = curate.scan(spark, history, NEIGHBORHOODS_STAGE, dates)
    snap = curate.snapshot(df, steps=[curate.clean_neighborhoods])
    if out is None:
        return snap
    curate.write(snap, out)
    return spark.read.orc(out)


@dataclass
class Staged:
    raw: str
    history: str
    bad: str
    counts: dict


def staged_customers(spark: SparkSession, sf_dir: str, days=(derive.DELIVERY_DAY,)) -> Staged:
    """Land the customer-derived boundary drop and run the stage job on it."""
    apply_job_conf(spark)
    base = scratch(spark, "boundaries")
    raw, history, bad = f"{base}/raw", f"{base}/stage", f"{base}/bad"
    landing.land(derive.boundary_lines(derive.table(spark, sf_dir, "customer"), days), raw)
    counts = stage_boundaries(spark, raw, history, bad, days=list(days))
    return Staged(raw, history, bad, counts)


def curated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = staged_customers(spark, sf_dir)
    return curate_boundaries(spark, st.history, st.history.replace("/stage", "/curated"))


@dataclass
class Published:
    loaded: int                 # rows in the landing table (count-checked)
    rejected: DataFrame         # curated rows that break the landing contract, with the rules broken
    typed_rejects: DataFrame    # landed rows that break the typed contract (P5), written
    shapes: DataFrame           # the written shape table, read back
    shape_rejects: DataFrame    # rows whose geometry did not parse, cleaned to nothing or is invalid
    key_violations: DataFrame   # empty: a shape table with duplicate or NULL keys is not published


def build_shapes(spark: SparkSession, landed: DataFrame, shape_path: str, typed_path: str | None = None, rejects_path: str | None = None):
    """P5 and G1-G11 over landed rows. Outcomes are computed once, into the shared folder; the keys of the shape
    table are checked there, and only then are the shape table and the rejects replaced.
    Returns ``(shapes, typed_rejects, shape_rejects)``, the rejects written where a path is given; raises :class:`geometry.KeyViolations` and leaves
    everything as it was if a key is duplicate or NULL."""
    ok, untyped = publish.split_violations(landed, publish.TYPED_RULES)
    path = scratch(spark, "outcomes")
    geometry.outcomes(ok, partitions=tasks_for(ok)).write.parquet(path)
    table, rejects = geometry.split_outcomes(spark.read.parquet(path))
    geometry.check_keys(table)
    table.select(*[c for c in geometry.SHAPE_COLUMNS if c in table.columns]).write.mode("overwrite").parquet(shape_path)
    return spark.read.parquet(shape_path), _kept(untyped, typed_path), _kept(rejects, rejects_path)


def _kept(rejects: DataFrame, path: str | None) -> DataFrame:
    if not path:
        return rejects
    rejects.write.mode("overwrite").parquet(path)
    return rejects.sparkSession.read.parquet(path)


def publish_and_shape(spark: SparkSession, curated: DataFrame, landing_table: str, shape_path: str,
                      rules=None, drop_landing: bool = True) -> Published:
    """The export and geometry build, in the reference's order:
    P4 contract check -> P1-P3 truncate-then-load with count check ->
    P5 typed contract -> G1-G10 shapes from the landing table, computed once -> G11 key check, which stops
    here with the old shape table and the landing table in place -> G10 written -> G12 staging clean-up. ``landing_table`` must
    exist (e.g. created from the warehouse DDL)."""
    ok, rejected = publish.split_violations(curated, rules or publish.LANDING_RULES)
    loaded = publish.load_table(ok, landing_table)
    shapes, typed_rejects, shape_rejects = build_shapes(spark, spark.table(landing_table), shape_path, f"{shape_path}_typed_rejects", f"{shape_path}_rejects")
    if drop_landing:
        geometry.drop_staging(spark, landing_table)
    return Published(loaded, rejected, typed_rejects, shapes, shape_rejects, geometry.key_violations(shapes))
