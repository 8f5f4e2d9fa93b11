"""Session helpers: a local session for tests/bench and a shared scratch area.

Library code never creates its own session; queries receive one. Scratch
output (CSV round trips, external tables, saved models, checkpoints) goes to
the folder the cluster names in ``spark.checkpoint.dir``. Only when that is
unset and the master is local (tests) do we create one under the system temp
folder, removed with all it holds when Python ends; ``drop_scratch`` removes
a configured folder's scratch tables.
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """Local session used by tests and bench; AQE on, UI off, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CKPT_KEY, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    master = sc.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"{_CKPT_KEY} is not set: on {master} scratch tables need a folder that executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-used path under the shared scratch area."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tessera-scratch/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete everything written by :func:`scratch_path` users; results read from there are gone, too."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/tessera-scratch")
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def written(df):
    """``df`` written as a parquet table in the shared checkpoint folder, read back, and the table's path."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path), path


def materialize(df):
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` -- small plans, no recomputation
    of upstream work, a lost executor only costs re-reading files -- in one
    job, and, unlike an RDD checkpoint, the write goes through adaptive
    execution: small results become a few files instead of one per shuffle
    partition, and later joins see real file sizes.
    """
    return written(df)[0]


def drop_written(spark: SparkSession, *paths: str) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished stages whose frames nobody holds any more.

    Its cleaner acts when the driver's JVM collects garbage, which a small
    driver heap may not do for a long time.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
