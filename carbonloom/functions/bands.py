"""Ordered classifications. NULL handling differs on purpose between the three index scales."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k


def by_upper_bound(value: Column, bands, after) -> Column:
    """First band whose inclusive upper bound is not exceeded, else ``after``; NULL falls to ``after``."""
    chain = reduce(
        lambda acc, band: acc.when(value <= F.lit(band[0]), F.lit(band[1])),
        bands[1:],
        F.when(value <= F.lit(bands[0][0]), F.lit(bands[0][1])),
    )
    return chain.otherwise(F.lit(after))


def tapio_band(index: Column, labels=k.TAPIO_LABELS) -> Column:
    """The view's scale: 0.8 is still weak, 1.2 still coupled, NULL counts as negative."""
    strong, weak, coupled, negative = labels
    return (
        F.when(index < 0, strong)
        .when(index <= k.TAPIO_WEAK, weak)
        .when(index <= k.TAPIO_COUPLED, coupled)
        .otherwise(negative)
    )


def green_band(index: Column, labels=k.GREEN_LABELS, high=k.GREEN_HIGH, middle=k.GREEN_MIDDLE) -> Column:
    green, between, risk = labels
    return F.when(index >= high, green).when(index >= middle, between).otherwise(risk)


def status_label(index: Column, labels=k.STATUS_LABELS) -> Column:
    """The report's scale: like :func:`tapio_band`, but NULL is 'No Data'."""
    none, strong, weak, coupled, negative = labels
    return (
        F.when(index.isNull(), none)
        .when(index < 0, strong)
        .when(index <= k.TAPIO_WEAK, weak)
        .when(index <= k.TAPIO_COUPLED, coupled)
        .otherwise(negative)
    )


def status_color(index: Column, colors=k.STATUS_COLORS) -> Column:
    none, strong, weak, other = colors
    return (
        F.when(index.isNull(), none)
        .when(index < 0, strong)
        .when(index <= k.TAPIO_WEAK, weak)
        .otherwise(other)
    )


def quadrant(size: Column, load: Column, avg_size: Column, avg_load: Column, labels=k.QUADRANTS) -> Column:
    big, heavy = size >= avg_size, load >= avg_load
    return (
        F.when(big & (load < avg_load), labels[0])
        .when(big & heavy, labels[1])
        .when((size < avg_size) & heavy, labels[2])
        .otherwise(labels[3])
    )


#: Bands of a table at most: it travels as one row.
MOST_BANDS = 4096


def by_band_table(df: DataFrame, value: Column, bands: DataFrame, out: str, after: Column | None = None) -> DataFrame:
    """``df`` with the label of the band (lower, upper, label) that holds ``value``, both ends inside; ``after`` where none does.

    The bands are sorted once, into one row; each value finds its band by halving steps over the upper ends, in a native
    expression, so there is no join by range. NULL ends are open. Bands that overlap, end before they begin or
    are more than ``MOST_BANDS`` fail the job.
    """
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    lower, upper = F.coalesce(F.col("lower").cast("double"), low), F.coalesce(F.col("upper").cast("double"), high)
    sorted_ = F.array_sort(F.collect_list(F.struct(lower.alias("lower"), upper.alias("upper"), F.col("label").cast("string").alias("label"))))
    table = bands.agg(sorted_.alias("t")).select("t", F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))).alias("a"), F.slice("t", 2, F.greatest(F.size("t"), F.lit(1))).alias("n"))
    overlap = F.exists(F.zip_with("a", "n", lambda x, y: x.upper >= y.lower), lambda x: x) | F.exists("t", lambda x: x.lower > x.upper)
    problem = F.when(F.size("t") > MOST_BANDS, "too many bands").when(F.coalesce(overlap, F.lit(False)), "bands overlap or end before they begin")
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("array<struct<lower:double,upper:double,label:string>>")).otherwise(F.col("t"))
    one = table.select(checked.alias("t")).scalar()
    steps = F.array(*(F.lit(MOST_BANDS >> i) for i in range(MOST_BANDS.bit_length())))
    wanted = value.cast("double")
    # how many bands end below the value
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_bands", at + step - 1).upper < F.col("_value"), at + step).otherwise(at))
    placed = df.withColumn("_bands", one).withColumn("_value", wanted).withColumn("_band", F.get("_bands", below))
    found = F.when((F.col("_value") >= F.col("_band.lower")) & (F.col("_value") <= F.col("_band.upper")), F.col("_band.label"))
    return placed.withColumn(out, found if after is None else F.coalesce(found, after)).drop("_bands", "_value", "_band")
