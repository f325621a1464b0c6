"""The four analytic queries, over the report views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as k
from ..functions import bands
from ..operators.ranking import share_within, top_of_latest


def top_emitters_latest_year(provincial: DataFrame, limit: int = 10) -> DataFrame:
    """Largest emitters of the latest year with their band and dense rank, ties by code."""
    top = top_of_latest(provincial, "Year", "Estimated_Carbon_Tonnes", "Province_Code", "Emission_Rank", limit)
    return top.select(
        "Year",
        "Province_Code",
        "Province_Name",
        "Region",
        "Economic_Zone",
        "Is_Industrial_Hub",
        F.col("Estimated_Carbon_Tonnes").alias("Carbon_Tonnes"),
        "GRDP_Billion_VND",
        "Decoupling_Index",
        bands.green_band(F.col("Decoupling_Index")).alias("Decoupling_Status"),
        "Emission_Rank",
    ).orderBy(F.col("Carbon_Tonnes").desc(), "Province_Code")


def decade_trend(national: DataFrame) -> DataFrame:
    """Per decade on total rows. The intensity divides a sum of CO2 by an average of GDP, as defined."""
    gdp = F.try_divide(F.sum("GDP_USD").cast("double"), F.count("GDP_USD"))
    co2 = F.sum("CO2_MtCO2e").cast("double")
    renewable = F.try_divide(F.sum("Renewable_Energy_Pct").cast("double"), F.count("Renewable_Energy_Pct"))
    intensity = F.when(gdp > 0, co2 * 1000000.0 / (gdp / 1000.0)).otherwise(F.lit(0.0))
    return (
        national.where(F.col("Sector_Code") == k.TOTAL_SECTOR)
        .groupBy("Decade")
        .agg(
            F.count_distinct("Year").alias("Years_Count"),
            F.round(renewable, 2).alias("Avg_Renewable_Pct"),
            F.round(co2, 2).alias("Total_CO2_MtCO2e"),
            F.round(gdp / 1000000000.0, 2).alias("Avg_GDP_Billion_USD"),
            F.round(intensity, 4).alias("Carbon_Intensity_Tonnes_Per_1k_USD"),
        )
        .orderBy("Decade")
    )


def sector_share_by_phase(national: DataFrame, gas: str = k.ALL_GASES, first_year: int = 1990) -> DataFrame:
    """Totals, averages and shares of sectors per plan phase, without the total row and for one gas."""
    chosen = national.where(
        (F.col("Sector_Code") != k.TOTAL_SECTOR) & (F.col("Gas") == gas) & (F.col("Year") >= first_year)
    )
    sums = chosen.groupBy("Five_Year_Plan_Phase", "Sector_Category", "Sector_Name_VI").agg(
        F.sum("Emissions_MtCO2e").alias("_total"), F.count("Emissions_MtCO2e").alias("_rows")
    )
    shared = share_within(sums, "_total", ["Five_Year_Plan_Phase"], "_pct", 100.0)
    total = F.col("_total").cast("double")
    return shared.select(
        "Five_Year_Plan_Phase",
        "Sector_Category",
        "Sector_Name_VI",
        F.round(total, 2).alias("Period_Total_Emissions_MtCO2e"),
        F.round(F.try_divide(total, F.col("_rows")), 2).alias("Annual_Avg_Emissions_MtCO2e"),
        F.round("_pct", 2).alias("Sector_Contribution_Pct"),
    ).orderBy("Five_Year_Plan_Phase", F.col("Period_Total_Emissions_MtCO2e").desc(), "Sector_Name_VI")


def quadrant_matrix(provincial: DataFrame, year: int = 2024) -> DataFrame:
    """Provinces of one year against the averages of that year."""
    chosen = provincial.where(F.col("Year") == year)
    means = chosen.groupBy("Year").agg(
        *(F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(n)
          for c, n in (("GRDP_Billion_VND", "_size"), ("Estimated_Carbon_Tonnes", "_load")))
    )
    return (
        chosen.join(means, "Year")
        .select(
            "Province_Code",
            "Province_Name",
            "Region",
            "GRDP_Billion_VND",
            "Estimated_Carbon_Tonnes",
            "Decoupling_Index",
            bands.quadrant(
                F.col("GRDP_Billion_VND").cast("double"),
                F.col("Estimated_Carbon_Tonnes").cast("double"),
                F.col("_size"),
                F.col("_load"),
            ).alias("Quadrant_Classification"),
        )
        .orderBy(F.col("GRDP_Billion_VND").desc(), "Province_Code")
    )
