"""Top rows and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def top_of_latest(
    df: DataFrame, period: str, measure: str, tie_break: str, rank: str, limit: int = 10
) -> DataFrame:
    """The ``limit`` largest rows of the latest period with their dense rank.

    Sorting by period first makes one top-k pass enough: the rows of the latest period come first,
    and the windows only see the ``limit`` rows that are left.
    """
    top = df.orderBy(F.col(period).desc(), F.col(measure).desc(), F.col(tie_break).asc()).limit(limit)
    everything = Window.partitionBy()
    by_size = Window.orderBy(F.col(measure).desc())
    return (
        top.withColumn("_latest", F.max(period).over(everything))
        .where(F.col(period) == F.col("_latest"))
        .drop("_latest")
        .withColumn(rank, F.dense_rank().over(by_size))
    )


def share_within(df: DataFrame, part: str, whole: Sequence[str], share: str, scale: float = 1.0) -> DataFrame:
    """``part`` as a share of its sum over ``whole``; NULL when that sum is 0.

    Sums per ``whole`` are aggregated and joined back, so a large group is not collected.
    """
    totals = df.groupBy(*whole).agg(F.sum(part).alias("_whole"))
    same = F.lit(True)
    for column in whole:
        same = same & F.col(f"l.{column}").eqNullSafe(F.col(f"r.{column}"))
    joined = df.alias("l").join(totals.alias("r"), same)
    ratio = F.try_divide(F.col(f"l.{part}").cast("double"), F.col("r._whole").cast("double"))
    return joined.select("l.*", (ratio * scale).alias(share))
