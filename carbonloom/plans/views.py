"""The eight report views: joins on surrogate keys and column expressions, so filters push down.

Date, hour and province dimensions are small; stations may not be, and their lookup takes salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as k
from ..functions import bands, calendar as cal, labels
from ..functions.ratios import guarded_ratio, total_row_guard
from ..operators.lookup import spread_lookup, star
from .facts import PROVINCIAL_MEASURES, READINGS


def vw_dim_date(dates: DataFrame) -> DataFrame:
    year = F.col("Year")
    return dates.select(
        "Date_Key",
        "Year",
        "Decade",
        "Five_Year_Plan_Phase",
        "Is_Target_Milestone",
        cal.year_end_date(year).alias("Year_Date"),
        cal.policy_period(year).alias("Policy_Period"),
        cal.is_pre_reform(year).cast("int").alias("Is_Pre_DoiMoi"),
        cal.is_reform_era(year).cast("int").alias("Is_DoiMoi_Era"),
        cal.is_milestone(year).cast("int").alias("Is_NetZero_Milestone"),
    )


def vw_dim_province(provinces: DataFrame, regions=k.MACRO_REGIONS) -> DataFrame:
    return provinces.select(
        "Province_Key",
        "Province_Code",
        "Province_Name",
        "Province_Name_Ascii",
        "Region",
        "Economic_Zone",
        "Area_Km2",
        "Is_Industrial_Hub",
        labels.flag_label(F.col("Is_Industrial_Hub"), k.HUB_LABELS).alias("Industrial_Hub_Label"),
        labels.macro_region(F.col("Region"), regions).alias("Macro_Region"),
    )


def vw_dim_sector(sectors: DataFrame) -> DataFrame:
    scope = labels.scope_or_default(F.col("Scope_Type"))
    return sectors.select(
        "Sector_Key",
        "Sector_Code",
        "Sector_Name_EN",
        "Sector_Name_VI",
        "Sector_Category",
        scope.alias("Scope_Type"),
        labels.hierarchy_path(scope, F.col("Sector_Category"), F.col("Sector_Name_VI")).alias("Sector_Hierarchy_Path"),
        F.coalesce(F.col("Sector_Code") == k.TOTAL_SECTOR, F.lit(False)).cast("int").alias("Is_Total_Sector"),
    )


def vw_fact_national(fact: DataFrame, dates: DataFrame, sectors: DataFrame) -> DataFrame:
    rows = star(
        fact,
        (dates.select("Date_Key", "Year", "Decade", "Five_Year_Plan_Phase"), "Date_Key"),
        (sectors.select("Sector_Key", "Sector_Code", "Sector_Name_VI", "Sector_Category", "Scope_Type"), "Sector_Key"),
    )
    return rows.select(
        "Emission_ID",
        "Date_Key",
        "Year",
        "Decade",
        "Five_Year_Plan_Phase",
        "Sector_Key",
        "Sector_Code",
        "Sector_Name_VI",
        "Sector_Category",
        labels.scope_or_default(F.col("Scope_Type")).alias("Scope_Type"),
        "Gas",
        "Emissions_MtCO2e",
        "CO2_MtCO2e",
        "Methane_MtCO2e",
        "Renewable_Energy_Pct",
        total_row_guard(F.col("GDP_USD"), F.col("Sector_Code"), k.TOTAL_SECTOR).alias("GDP_USD"),
        F.col("GDP_USD").alias("Raw_GDP_USD_Unsafe"),
    )


def vw_fact_provincial(fact: DataFrame, dates: DataFrame, provinces: DataFrame) -> DataFrame:
    rows = star(fact, (dates.select("Date_Key", "Year", "Decade"), "Date_Key"), (provinces, "Province_Key"))
    carbon = F.col("Estimated_Carbon_Tonnes")
    return rows.select(
        "Economy_ID",
        "Date_Key",
        "Year",
        "Decade",
        "Province_Key",
        "Province_Code",
        "Province_Name",
        "Province_Name_Ascii",
        "Region",
        "Economic_Zone",
        "Area_Km2",
        "Is_Industrial_Hub",
        *PROVINCIAL_MEASURES,
        bands.tapio_band(F.col("Decoupling_Index")).alias("Decoupling_Status"),
        guarded_ratio(carbon, F.col("GRDP_Billion_VND")).alias("Carbon_Intensity_Tonnes_Per_Billion_VND"),
        guarded_ratio(carbon, F.col("Population")).alias("Carbon_Per_Capita_Tonnes"),
        guarded_ratio(carbon, F.col("Area_Km2")).alias("Carbon_Density_Tonnes_Per_Km2"),
    )


def vw_dim_station(stations: DataFrame, provinces: DataFrame) -> DataFrame:
    place = provinces.select("Province_Key", "Province_Code", "Province_Name", "Region", "Economic_Zone")
    return stations.join(place, "Province_Key").select(
        "Station_Key",
        "Station_Code",
        "Station_Name",
        "Province_Key",
        "Province_Code",
        "Province_Name",
        "Region",
        "Economic_Zone",
        "Station_Type",
        "Latitude",
        "Longitude",
        "Is_Active",
    )


def vw_dim_time_of_day(hours: DataFrame) -> DataFrame:
    return hours.select(
        "Time_Key",
        "Hour_24",
        "Hour_Label",
        "Time_Bucket",
        "Is_Rush_Hour",
        labels.flag_label(F.col("Is_Rush_Hour"), k.RUSH_LABELS).alias("Rush_Hour_Label"),
    )


def vw_fact_hourly(
    fact: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
    provinces: DataFrame,
    stations: DataFrame,
    salts: int | None = None,
) -> DataFrame:
    """Month and day are not part of the view: its date is the year alone."""
    rows = star(
        fact,
        (dates.select("Date_Key", "Year"), "Date_Key"),
        (hours, "Time_Key"),
        (provinces.select("Province_Key", "Province_Code", "Province_Name", "Region"), "Province_Key"),
    )
    places = stations.select("Station_Key", "Station_Code", "Station_Name", "Station_Type", "Latitude", "Longitude")
    return spread_lookup(rows, places, "Station_Key", F.col("Monitoring_ID"), salts=salts).select(
        "Monitoring_ID",
        "Date_Key",
        "Year",
        "Time_Key",
        "Hour_24",
        "Hour_Label",
        "Time_Bucket",
        "Is_Rush_Hour",
        "Province_Key",
        "Province_Code",
        "Province_Name",
        "Region",
        "Station_Key",
        "Station_Code",
        "Station_Name",
        "Station_Type",
        "Latitude",
        "Longitude",
        *READINGS,
        "AQI_Index",
        "AQI_Category",
        "Is_Exceeding_QCVN",
        labels.flag_label(F.col("Is_Exceeding_QCVN"), k.LIMIT_LABELS).alias("QCVN_Compliance_Label"),
    )
