"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark. On a cluster, use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wardmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table_root(spark: SparkSession) -> str:
    """A new folder for this run's tables, below the cluster's shared folder.

    Without ``spark.checkpoint.dir`` only a plain local master may fall back to the
    machine's own temporary folder: executors of any other master cannot see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="wardmart-")
    run = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
    return f"{shared.rstrip('/')}/wardmart/{run}"
