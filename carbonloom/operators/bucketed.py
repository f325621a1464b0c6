"""Dimension merge on bucketed tables: the target is neither shuffled nor broadcast.

The target lies in buckets of its natural key, one sorted file each. A merge brings the source into the same buckets
and joins bucket by bucket; the result is in the same buckets again and is written without another exchange, as a table of
its own. Only the source, which is small beside the target, moves.

Bucketed tables are known by name in the session's catalog; :func:`attach` names the files of an earlier session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .keys import dense_keys
from .merge import one_row_per_key


def save(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """The rows as a bucketed table at ``path``, one file per bucket where ``df`` is in those buckets already."""
    if df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"{table} is there already: each version is a table of its own")
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def create(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """The first version: the one time that the rows are shuffled."""
    return save(df.repartition(buckets, F.col(key)), table, path, key, buckets)


def attach(spark: SparkSession, table: str, path: str, ddl: str, key: str, buckets: int) -> DataFrame:
    """Names the bucketed files at ``path`` in this session."""
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def merged(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    surrogate: str,
    keep_if_null: Sequence[str] = (),
    insert_default: dict[str, object] | None = None,
) -> DataFrame:
    """The rows of :func:`merge.scd1_merge`, in the buckets of ``target``.

    One full join by bucket: rows that only the target has stay, shared ones are updated, new ones get keys that were
    numbered among the new rows alone.
    """
    defaults = insert_default or {}
    source = one_row_per_key(source.select(key, *update), key)
    last = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("last")).scalar()
    # keys of the new rows: the anti join is by bucket, and only rows of the source are numbered
    fresh = dense_keys(source.select(key).join(target.select(key), key, "left_anti"), key, "_fresh", last)
    new = source.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_s_{c}") for c in update))
    new = new.join(fresh.select(F.col(key).alias("_key"), "_fresh"), "_key", "left").withColumn("_matched", F.lit(True))
    both = target.join(new, target[key] == F.col("_key"), "full")
    is_new = F.col("_fresh").isNotNull()

    def value(column: str) -> Column:
        old, now = F.col(column), F.col(f"_s_{column}")
        inserted = F.coalesce(now, F.lit(defaults[column])) if column in defaults else now
        updated = F.coalesce(now, old) if column in keep_if_null else now
        return F.when(is_new, inserted).when(F.col("_matched"), updated).otherwise(old)

    def out(column: str) -> Column:
        if column == key:
            found = F.coalesce(F.col(key), F.col("_key"))
        elif column == surrogate:
            found = F.coalesce(F.col(surrogate), F.col("_fresh"))
        elif column in update:
            found = value(column)
        else:
            found = F.col(column)
        return found.cast(target.schema[column].dataType).alias(column)

    return both.select(*(out(c) for c in target.columns))
