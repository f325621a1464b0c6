"""Yearly series: values of earlier years, running sums, keep-first, long-to-wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def with_lags(
    df: DataFrame,
    keys: Sequence[str],
    year: str,
    value: str,
    lags: Sequence[int],
    last_year: int | None = None,
) -> DataFrame:
    """``value`` of the year itself and of ``year - lag`` exactly, for each (keys, year) where any exists.

    Needs one row per (keys, year). Each row is sent to the years that look back at it, and one
    aggregate brings them together; so a year without data but with a prior year is a row as well,
    and no key is collected into a window.
    """
    offsets = [0, *lags]
    sent = df.select(
        *keys,
        F.col(value).alias("_v"),
        F.col(year).alias("_from"),
        F.explode(F.array(*(F.lit(o) for o in offsets))).alias("_lag"),
    ).withColumn(year, F.col("_from") + F.col("_lag"))
    if last_year is not None:  # for years made by a lag only: a row's own year stays
        sent = sent.where((F.col("_lag") == 0) | (F.col(year) <= last_year))

    def pick(lag: int) -> Column:
        return F.max(F.when(F.col("_lag") == lag, F.col("_v")))

    return sent.groupBy(*keys, year).agg(
        pick(0).alias(value), *(pick(lag).alias(f"{value}_minus_{lag}") for lag in lags)
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order; Spark drops later rows of a key before the shuffle."""
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_first", first).where("_first = 1").drop("_first")


def nonempty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with at least one value in ``columns``."""
    return df.dropna(how="all", subset=list(columns))


def pivot_first(
    df: DataFrame, key: str, names: str, value: str, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Long to wide with the first non-NULL value by ``order``; one aggregate, columns given up front.

    Keys whose values are all NULL are left out.
    """

    # a single column needs no struct, and fixed-width values can be aggregated in place
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    def first(name: str) -> Column:
        wanted = (F.col(names) == name) & F.col(value).isNotNull()
        return F.min_by(F.when(wanted, F.col(value)), F.when(wanted, place)).alias(name)

    wide = df.where(F.col(names).isin(*columns)).groupBy(key).agg(*(first(c) for c in columns))
    return nonempty_rows(wide, columns)


def running_sums(
    df: DataFrame, keys: Sequence[str], position: str, values: Sequence[str], block: int = 4096
) -> DataFrame:
    """Running sums of ``values`` by ``position`` within ``keys``, for keys of any length.

    Positions are cut into blocks that are summed on their own; the totals of earlier blocks come
    from a window over one row per block, so the longest key adds 1/block of its rows to one task.
    """
    cut = df.withColumn("_block", F.floor(F.col(position) / block).cast("long"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_block").agg(*(F.sum(v).alias(f"_t_{v}") for v in values))
    before = totals.select(
        *keys, "_block", *(F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_b_{v}") for v in values)
    )
    inside = (
        Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = cut.select("*", *(F.sum(v).over(inside).alias(f"_i_{v}") for v in values))
    return summed.join(before, [*keys, "_block"]).select(
        *df.columns, *((F.col(f"_b_{v}") + F.col(f"_i_{v}")).alias(f"running_{v}") for v in values)
    )
