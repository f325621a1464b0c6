"""Surrogate keys without a global sort.

A plain ``row_number`` over a whole table runs in one task, so none is used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HASH_DIGITS = 3


def dense_keys(
    df: DataFrame, natural_key: str, key: str, start: Column | int = 0, digits: int = HASH_DIGITS
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, …`` in the order (hash prefix, natural key).

    ``natural_key`` must be unique; a NULL one fails the job. Rows are numbered inside 16**digits hash buckets; only the
    bucket counts (16**digits rows at most) are summed up in one place.
    """
    text = F.coalesce(F.col(natural_key).cast("string"), F.raise_error(F.lit(f"NULL in natural key {natural_key}")))
    bucketed = df.withColumn("_bucket", F.substring(F.md5(text), 1, digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    return (
        bucketed.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (F.col("_offset") + F.col("_inside") + start).cast("long"))
        .drop("_bucket", "_inside", "_offset")
    )


def packed_key(*parts: tuple[Column, int]) -> Column:
    """One exact BIGINT from (column, exclusive upper bound) parts, most significant first.

    The bound of the first part is not used. No shuffle and no collisions, unlike a hash; a value
    outside its bound fails the job rather than giving a duplicate.
    """
    total = parts[0][0].cast("long")
    for column, bound in parts[1:]:
        value = column.cast("long")
        inside = (value >= 0) & (value < bound)
        checked = F.when(inside, value).when(
            value.isNotNull(), F.raise_error(F.concat(F.lit("key part out of bounds: "), value.cast("string")))
        )
        total = total * F.lit(bound).cast("long") + checked.cast("long")
    return total
