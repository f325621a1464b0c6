"""Tables written to the folder that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from carbonloom.session import work_dir


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder in local mode, and an error on a cluster."""
    named = work_dir(spark, "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="carbonloom-")


def let_go(spark: SparkSession) -> None:
    """Shuffle files go when the driver has dropped the plans that wrote them; its collector is asked, as it may not run for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: what follows starts from the files, also when executors are lost."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
