"""Session helpers: a configured session for scripts/tests and the shared
scratch folder every job writes intermediate tables to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Dynamic partition overwrite keeps other load
# dates of a history table when one date is reloaded (S13); UTC matches the
# export clock of the warehouse load.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows bound for a few folders are written as they come; without this each task sorts its rows first,
    # which for wide rows means spilling them. Beyond so many folders at once a task sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Arrow batches for the geometry UDFs are bounded by bytes, not only by
    # row count: 10,000 large polygons must not land in one Python batch.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build(master: str | None = None, app: str = "terrafold", **conf) -> SparkSession:
    """Session for scripts and tests. On a cluster pass ``master=None`` and
    let spark-submit decide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **JOB_CONF,
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the jobs depend on (all are SQL confs)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that Python functions find it whatever folder workers start
    in. Once per application; a remote session sends it as an artifact."""
    import terrafold

    root = os.path.dirname(os.path.abspath(terrafold.__file__))
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # a remote (Connect) session has no SparkContext
        app = None
    if (app or str(id(spark))) in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="terrafold-ship-"), "terrafold.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith((".py", ".json")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    if app:
        spark.sparkContext.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(app or str(id(spark)))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session, so reliable checkpoints and intermediate tables
    survive the loss of an executor. A local session that names none gets a
    folder of its own, deleted when Python ends; on a cluster that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None:
        d = d or sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="terrafold-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared directory for one run of one job."""
    return f"{shared_dir(spark)}/terrafold/{name}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows dealt evenly over ``partitions`` tasks before CPU-heavy per-row work; None leaves ``df`` as it is."""
    return df.repartition(partitions) if partitions else df


def tasks_for(df: DataFrame, split_bytes: int = 32 << 20) -> int | None:
    """The cluster's cores where the planned size of ``df`` gives them less than ``split_bytes`` each (one split of
    a small table would keep all but one idle), else None. Read from the optimizer's statistics: no job runs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return cores if size < cores * split_bytes else None
