"""Exact medians without shuffling or holding a column's values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

BUCKETS = 4096
#: Ranks this far (as a share of the rows) below and above the middle bracket the median; ten times what the
#: approximate percentiles may be off at ACCURACY.
MARGIN, ACCURACY = 0.001, 10_000


def value_pairs(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """(column, value) for each numeric column, as doubles."""
    pairs = (
        F.struct(F.lit(prefix + c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    )
    return df.select(F.inline(F.array(*pairs)))


def bracket(column):
    """(lo, hi) around the middle ranks as an aggregate of one column."""
    return F.percentile_approx(column, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY)


def brackets(pairs: DataFrame) -> DataFrame:
    """(column, rows, lo, hi) in one pass; a bracket holds both middle ranks."""
    found = pairs.where(F.col("value").isNotNull()).groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), bracket("value").alias("ends")
    )
    return found.select("column", "rows", F.col("ends")[0].alias("lo"), F.col("ends")[1].alias("hi"))


def exact_medians(pairs: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """(column, median) over (column, value) rows, NULLs skipped, the two middle values averaged.

    ``ranges`` is :func:`brackets` (or the same from another pass): one row per column, so it is broadcast. One more
    pass counts the rows below each bracket and the values inside, equal ones together; the 0.2 % or so of
    distinct values inside are cut into ``BUCKETS`` buckets, whose totals find the buckets of the middle ranks. Only
    inside such a bucket are values numbered. Outliers do not widen a bracket, as its ends are ranks.
    """
    ranges = brackets(pairs) if ranges is None else ranges
    inside = (
        pairs.where(F.col("value").isNotNull())
        .join(F.broadcast(ranges), "column")
        .where(F.col("value") <= F.col("hi"))
    )
    share = F.try_divide((F.col("value") - F.col("lo")) * BUCKETS, F.col("hi") - F.col("lo"))
    below = F.col("value") < F.col("lo")
    counts = inside.groupBy(
        "column",
        "rows",
        F.when(below, F.lit(-1.0)).otherwise(F.coalesce(F.floor(share).cast("double"), F.lit(0.0))).alias("bucket"),
        F.when(~below, F.col("value")).alias("value"),
    ).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("column", "rows", "bucket").agg(F.sum("n").alias("n")).select(
        "column", "rows", "bucket", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    first, second = F.floor((F.col("rows") + 1) / 2), F.floor(F.col("rows") / 2) + 1

    def holds(rank):
        return (F.col("before") < rank) & (rank <= F.col("before") + F.col("n"))

    # at most two buckets per column; no condition on the bucket itself, which would make this a scan of its own
    middle = totals.where(holds(first) | holds(second)).select("column", "bucket", "before")
    some = counts.join(F.broadcast(middle), ["column", "bucket"])
    upto = Window.partitionBy("column", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    some = some.withColumn("upto", F.col("before") + F.sum("n").over(upto)).withColumn("before", F.col("upto") - F.col("n"))
    hits = holds(first).cast("int") + holds(second).cast("int")
    ranked = some.withColumn("hits", hits).where("hits > 0")
    return ranked.groupBy("column").agg((F.sum(F.col("value") * F.col("hits")) / F.sum("hits")).alias("median"))
