"""Session helpers: a local session for tests/bench and the shared folder for materialised tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "coderail") -> SparkSession:
    """Local session used by tests and the bench. Cluster jobs get their session from the launcher."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CODERAIL_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in local mode (tests) a private folder is created and set,
    so that ``DataFrame.checkpoint()`` and written intermediate tables land in one place.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                # A machine-local folder would vanish with the executor that wrote it.
                raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by the cluster")
            d = tempfile.mkdtemp(prefix="coderail-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one materialised table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/coderail/{name}/{uuid.uuid4().hex}"
