"""The steps of the boundaries product as jobs for ``spark-submit``.

    spark-submit terrafold/jobs.py STEP --in PATH --out PATH [options]

discover  manifest + landed root (--landed)  -> new items, JSON
land      folder of zip archives             -> landed root
stage     landed root, --days or all of them -> history (ORC by load date); --bad for malformed lines
curate    history                            -> snapshot (ORC)
publish   snapshot                           -> catalog table (--table); --bad for refused rows
shape     catalog table (--table)            -> shape table (parquet); --bad for rows without a shape

Each step reads what the one before wrote, and replaces its own output."""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from terrafold.operators import delivery, landing, publish  # noqa: E402
from terrafold.plans import boundaries  # noqa: E402
from terrafold.session import apply_job_conf, ship  # noqa: E402
from terrafold.sources import archive  # noqa: E402


def _kept(rejects: DataFrame, path: str | None) -> int:
    """Rejected rows, written where a path is given and counted either way."""
    if not path:
        return rejects.count()
    rejects.write.mode("overwrite").parquet(path)
    return rejects.sparkSession.read.parquet(path).count()


def discover(spark: SparkSession, a) -> dict:
    products = [p for _, p in delivery.PRODUCT_RULES]
    items = delivery.manifest(spark, a.source, multi_line=a.pretty)
    marks = delivery.last_loaded(delivery.listing(spark, a.landed), products=products)
    found = delivery.new_inventory(items, marks, combined_mark=a.combined, products=products)
    found.where("is_new").write.mode("overwrite").json(a.out)
    return {"new": spark.read.schema(found.schema).json(a.out).count()}


def land(spark: SparkSession, a) -> dict:
    """Empty members land as empty files; with --ledger each member is told new, changed, renamed or resent, and recorded."""
    found = landing.label(archive.members(spark, a.source))
    told = {}
    if a.ledger:
        told = {r["arrival"]: r["count"] for r in landing.arrivals(found, landing.ledger(spark, a.ledger)).groupBy("arrival").count().collect()}
    landing.land(landing.label(archive.unpack(spark, a.source)), a.out)
    empty = landing.land_empty(found, a.out)
    if a.ledger:
        landing.record(found, a.ledger)
    return {**told, "empty": empty}


def stage(spark: SparkSession, a) -> dict:
    # without --days, the landed delivery folders (as many as there are deliveries)
    days = a.days or sorted(r["name"] for r in delivery.listing(spark, a.source).where("product = 'neighborhoods'").collect())
    return boundaries.stage_boundaries(spark, a.source, a.out, a.bad, days=days, load_date=a.load_date, table=a.table,
                                       bad_by="parent_folder_name", run_date=a.run_date)


def curate(spark: SparkSession, a) -> dict:
    return {"rows": boundaries.curate_boundaries(spark, a.source, a.out, a.dates).count()}


def publish_(spark: SparkSession, a) -> dict:
    ok, refused = publish.split_violations(spark.read.orc(a.source))
    return {"loaded": publish.load_table(ok, a.table), "refused": _kept(refused, a.bad)}


def shape(spark: SparkSession, a) -> dict:
    """Stops without replacing anything if a key is duplicate or NULL."""
    shapes, untyped, rejects = boundaries.build_shapes(spark, spark.table(a.table), a.out, a.bad and f"{a.bad}/typed", a.bad and f"{a.bad}/shape")
    return {"shapes": shapes.count(), "untyped": untyped.count(), "rejected": rejects.count(), "key_violations": 0}


STEPS = {"discover": discover, "land": land, "stage": stage, "curate": curate, "publish": publish_, "shape": shape}
NEEDS = {"discover": ("source", "landed", "out"), "land": ("source", "out"), "stage": ("source", "out"), "curate": ("source", "out"),
         "publish": ("source", "table"), "shape": ("table", "out")}


def main(argv=None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="terrafold", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("step", choices=STEPS)
    p.add_argument("--in", dest="source")
    p.add_argument("--out")
    p.add_argument("--bad", help="folder for rows the step refuses")
    p.add_argument("--table", help="catalog table")
    p.add_argument("--landed", help="landed root (discover)")
    p.add_argument("--ledger", help="ledger of landed members (land)")
    p.add_argument("--pretty", action="store_true", help="the manifest is one multi-line document (discover)")
    p.add_argument("--combined", action="store_true", help="one mark for all products (discover)")
    p.add_argument("--days", nargs="+", help="delivery folders (stage)")
    p.add_argument("--load-date", help="yyyy-MM-dd for every row (stage)")
    p.add_argument("--run-date", help="yyyy-MM-dd for folders that are no date (stage); default: today, UTC")
    p.add_argument("--dates", nargs="+", help="load dates to read (curate)")
    a = p.parse_args(argv)
    missing = [n for n in NEEDS[a.step] if getattr(a, n) is None]
    if missing:
        p.error(f"{a.step} needs " + ", ".join("--in" if n == "source" else f"--{n}" for n in missing))
    spark = spark or SparkSession.builder.appName(f"terrafold-{a.step}").getOrCreate()
    ship(apply_job_conf(spark))
    out = STEPS[a.step](spark, a)
    print(f"{a.step}: " + (", ".join(f"{k}={v}" for k, v in out.items()) or "done"))
    return out


if __name__ == "__main__":
    main()
