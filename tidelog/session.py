"""Session settings this package expects."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Semantics-bearing settings only; sizing belongs to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, name: str = "tidelog") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Inputs of one machine are small: adaptive execution may keep all its cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        # No call-site capture per expression: plans here have hundreds of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors can reach, as named by the cluster."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder; without one, a temporary folder if the whole session runs on this machine."""
    folder = shared_folder(spark)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidelog-")
    return folder.rstrip("/")
