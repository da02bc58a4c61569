"""Session defaults and the shared scratch folder."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Shuffle partition counts are left to the cluster (AQE coalesces).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", scratch: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench; ``scratch`` is its shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("dayloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", scratch or tempfile.mkdtemp(prefix="dayloom-"))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine, whose driver and executors share one disk, gets a folder of its own;
    on a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="dayloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
