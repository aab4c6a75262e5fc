"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is created by the platform; library code only reads
``spark.checkpoint.dir`` from it. A local folder is chosen only when that
setting is unset (tests, local bench runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "censa") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CENSA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoints of intermediate tables are removed once no plan uses them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared scratch folder of the session.

    A folder that is already set (``setCheckpointDir``, or the cluster's
    ``spark.checkpoint.dir``) is kept. Where none is set, a local session
    (tests, bench) gets a temporary one; any other master raises, since its
    executors could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver "
                             f"and all executors share (master {sc.master})")
        path = tempfile.mkdtemp(prefix="censa-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared scratch folder, for written outputs."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

