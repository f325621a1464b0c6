"""Parquet tables: staging with lineage, and dimensions in versions. Facts are in :mod:`snapshots`."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.constraints import Rule, enforce, enforce_unique, required


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("Loaded_At", F.current_timestamp()).withColumn("Source_File", F.lit(source))


def stage_overwrite(df: DataFrame, path: str, source: str) -> None:
    """Truncate and reload a staging table with its lineage columns."""
    rows = with_lineage(df, source)
    rows.write.mode("overwrite").parquet(path)
    remember_schema(df.sparkSession, path, rows.schema)


def truncate(spark: SparkSession, path: str) -> None:
    """Empties a table and keeps its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, files: Sequence[str]) -> None:
    """Deletes single files."""
    for name in files:
        fs, target = _file_system(spark, name)
        fs.delete(target, False)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one step: written aside, then renamed over the old one."""
    fs, aside = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(aside), context.makeQualified(hadoop.Path(path)), overwrite)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of a dimension's current version; None before the first load.

    Versions without a pointer are not a first load: keys given out before would be given out anew.
    """
    name = _read_text(spark, f"{path}/current")
    if name is None and exists(spark, f"{path}/versions"):
        raise FileNotFoundError(f"{path}: versions without a pointer to the current one")
    return None if name is None else f"{path}/versions/{name.strip()}"


def publish_dimension(
    spark: SparkSession, df: DataFrame, path: str, key: str, natural: str | None = None, rules: Sequence[Rule] = ()
) -> None:
    """A new version of a dimension, which may read the old one: written aside, checked, then pointed to.

    The pointer is one small file that is replaced in one step, so readers and a job that failed midway find the
    old version whole. The version before stays for readers at work; older ones go.
    """
    old, name = published(spark, path), uuid.uuid4().hex
    folder = f"{path}/versions/{name}"
    df.write.parquet(folder)
    ready = spark.read.schema(df.schema).parquet(folder)
    keys = [key] if natural is None else [key, natural]
    enforce(ready, path, [*(required(c) for c in keys), *rules])
    for column in keys:
        enforce_unique(ready, path, [column])
    _write_text(spark, f"{path}/current", name)
    fs, versions = _file_system(spark, f"{path}/versions")
    for status in fs.listStatus(versions):
        found = status.getPath()
        if found.getName() not in (name, (old or "").rsplit("/", 1)[-1]):
            fs.delete(found, True)


def remembered_schema(spark: SparkSession, path: str) -> StructType | None:
    text = _read_text(spark, f"{path}__schema")
    return None if text is None else StructType.fromJson(json.loads(text))


def remember_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Kept beside a table, so that opening it needs no job."""
    if remembered_schema(spark, path) != schema:
        _write_text(spark, f"{path}__schema", schema.json())
