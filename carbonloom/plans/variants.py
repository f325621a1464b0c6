"""Corrected variants of measures whose usual form differs from their name. Kept apart on purpose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import constants as k
from ..functions.ratios import divide, growth
from ..operators.series import with_lags


def tapio_elasticity(provincial: DataFrame, by: Sequence[str]) -> DataFrame:
    """Relative change of carbon over relative change of GRDP against the year before."""
    sums = provincial.groupBy(*by, "Year").agg(
        F.struct(F.sum("Estimated_Carbon_Tonnes").alias("c"), F.sum("GRDP_Billion_VND").alias("g")).alias("v")
    )
    lagged = with_lags(sums, by, "Year", "v", [1])
    carbon = growth(F.col("v.c"), F.col("v_minus_1.c"))
    grdp = growth(F.col("v.g"), F.col("v_minus_1.g"))
    return (
        lagged.where(F.col("v").isNotNull() & F.col("v_minus_1").isNotNull())
        .select(*by, "Year", carbon.alias("Carbon_Growth"), grdp.alias("GRDP_Growth"))
        .withColumn("Elasticity", divide(F.col("Carbon_Growth"), F.col("GRDP_Growth")))
    )


def daily_limit(readings: DataFrame, limit: float = k.PM25_LIMIT) -> DataFrame:
    """The 24-hour norm applied to the mean of each station and day."""
    day = readings.groupBy("Station_Code", "Year", "Month", "Day").agg(
        F.try_divide(F.sum("PM25_ug_m3").cast("double"), F.count("PM25_ug_m3")).alias("Mean_PM25")
    )
    return day.withColumn("Is_Exceeding", F.col("Mean_PM25") > limit)
