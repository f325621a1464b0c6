"""Generated dimensions. Their size is fixed by their range, so joins with them may broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as k
from ..functions import calendar as cal


def dim_date(spark: SparkSession, first: int = k.FIRST_YEAR, last: int = k.LAST_YEAR) -> DataFrame:
    year = F.col("Year")
    return spark.range(first, last + 1, numPartitions=1).select(F.col("id").cast("int").alias("Year")).select(
        year.alias("Date_Key"),
        "Year",
        cal.decade(year).alias("Decade"),
        cal.plan_phase(year).alias("Five_Year_Plan_Phase"),
        cal.is_milestone(year).alias("Is_Target_Milestone"),
    )


def dim_time_of_day(spark: SparkSession) -> DataFrame:
    hour = F.col("Time_Key")
    return spark.range(0, 24, numPartitions=1).select(F.col("id").cast("int").alias("Time_Key")).select(
        "Time_Key",
        hour.cast("short").alias("Hour_24"),
        cal.hour_label(hour).alias("Hour_Label"),
        cal.time_bucket(hour).alias("Time_Bucket"),
        cal.is_rush_hour(hour).alias("Is_Rush_Hour"),
    )


def sector_seed(spark: SparkSession, rows=k.SECTOR_SEED) -> DataFrame:
    return spark.createDataFrame(
        rows,
        "Sector_Code string, Sector_Name_EN string, Sector_Name_VI string, Sector_Category string, Scope_Type string",
    )
