"""Spark session for tests, the bench and local work. On a cluster the caller brings its own."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str = "carbonloom", cpus: str | int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # building plans takes fewer calls
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, default: str) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; ``default`` only where unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or default


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name that the driver and all executors see; in local mode a temporary one where nothing is named."""
    shared = work_dir(spark, "")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="carbonloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
