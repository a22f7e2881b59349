"""Spark session helpers.

The library never hard-codes cluster settings: callers pass their own
session.  ``get_spark`` is a convenience for tests, the bench and scripts.
"""
from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness of the operators (UTC for the
# timestamp_ntz <-> timestamp round trips, ANSI for explicit nulls on /0).
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # no Python call sites on expressions: capturing one costs more than building the expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # remove checkpoint files once the checkpointed DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "bazaar",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only with a local master (tests, a laptop) an unset one becomes a scratch
    folder; elsewhere it is an error, as executors would not share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    target = configured or tempfile.mkdtemp(prefix="bazaar-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df):
    """Cut lineage at a reused intermediate with a reliable checkpoint in the
    session's checkpoint folder (shared storage on a cluster; never local).

    The frame is cached first so the checkpoint write reads the cached
    blocks instead of running the plan a second time; the cache is released
    once the checkpoint files exist (lost executors then cost nothing).
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def ship_code(spark: SparkSession) -> None:
    """Make ``bazaar`` importable in the Python workers (once per SparkContext).

    Only the Arrow-batched passes run Python on executors, and their
    functions are pickled by module reference, so the package is zipped and
    distributed with ``addPyFile``.  A no-op when already shipped.
    """
    try:
        sc = spark.sparkContext
    except Exception:            # Spark Connect: no SparkContext; artifacts are the user's to add
        return
    if getattr(sc, "_bazaar_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="bazaar-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "bazaar"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="bazaar")
    sc.addPyFile(archive)
    sc._bazaar_shipped = True
