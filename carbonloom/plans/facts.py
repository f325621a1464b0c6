"""Fact rows from staged rows and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k
from ..functions.ratios import total_row_guard
from ..operators.constraints import Rule, non_negative, percentage, required
from ..operators.keys import packed_key
from ..operators.lookup import spread_lookup, star

PROVINCIAL_MEASURES = (
    "GRDP_Billion_VND",
    "Population",
    "Industrial_Output_Billion_VND",
    "Forest_Coverage_Pct",
    "Estimated_Carbon_Tonnes",
    "Decoupling_Index",
)
READINGS = ("CO2_ppm", "CO_mg_m3", "NO2_ug_m3", "SO2_ug_m3", "PM25_ug_m3", "PM10_ug_m3")

# Upper bounds of key parts: years, gases, hours since 1970.
YEARS, GAS_SLOTS, HOURS = 10_000, 16, 1 << 21

NATIONAL_RULES = [
    required("Emission_ID"),
    required("Date_Key"),
    required("Sector_Key"),
    non_negative("Emissions_MtCO2e", null_ok=False),
    non_negative("CO2_MtCO2e"),
    non_negative("Methane_MtCO2e"),
    percentage("Renewable_Energy_Pct"),
    non_negative("GDP_USD"),
]
PROVINCIAL_RULES = [
    required("Economy_ID"),
    required("Date_Key"),
    required("Province_Key"),
    *(non_negative(c, null_ok=False) for c in PROVINCIAL_MEASURES[:3]),
    percentage("Forest_Coverage_Pct", null_ok=False),
    non_negative("Estimated_Carbon_Tonnes", null_ok=False),
    required("Decoupling_Index"),
]
HOURLY_RULES: list[Rule] = [
    required(c) for c in ("Monitoring_ID", "Date_Key", "Time_Key", "Province_Key", "Station_Key", *READINGS, "AQI_Index")
]


def national_fact(
    sectors: DataFrame, dates: DataFrame, dim_sector: DataFrame, national: DataFrame, gases: tuple[str, ...] = k.GASES
) -> DataFrame:
    """Driven by the sector rows: years without them are not in the fact, national years without them are lost.

    GDP and renewables stay on the total row only; CO2 and methane repeat on every row of a year.
    """
    rows = star(
        sectors.select("Year", "Sector_Code", "Gas", "Emissions_MtCO2e"),
        (dates.select("Date_Key", "Year"), "Year"),
        (dim_sector.select("Sector_Key", "Sector_Code"), "Sector_Code"),
    ).join(
        national.select("Year", "CO2_MtCO2e", "Methane_MtCO2e", "Renewable_Energy_Pct", "GDP_USD"), "Year", "left"
    )
    code = F.col("Sector_Code")
    slot = F.array_position(F.array(*(F.lit(g) for g in gases)), F.col("Gas"))
    unknown = F.raise_error(F.concat(F.lit("unknown gas: "), F.coalesce(F.col("Gas"), F.lit("NULL"))))
    gas_slot = F.when(slot > 0, slot).otherwise(unknown.cast("long"))
    return rows.select(
        packed_key((F.col("Sector_Key"), 0), (F.col("Date_Key"), YEARS), (gas_slot, GAS_SLOTS)).alias("Emission_ID"),
        "Date_Key",
        "Sector_Key",
        "Gas",
        F.coalesce("Emissions_MtCO2e", F.lit(0)).alias("Emissions_MtCO2e"),
        "CO2_MtCO2e",
        "Methane_MtCO2e",
        total_row_guard(F.col("Renewable_Energy_Pct"), code, k.TOTAL_SECTOR).alias("Renewable_Energy_Pct"),
        total_row_guard(F.col("GDP_USD"), code, k.TOTAL_SECTOR).alias("GDP_USD"),
    )


def provincial_fact(economy: DataFrame, dates: DataFrame, dim_province: DataFrame) -> DataFrame:
    """Missing measures become 0."""
    rows = star(
        economy.select("Year", "Province_Code", *PROVINCIAL_MEASURES),
        (dates.select("Date_Key", "Year"), "Year"),
        (dim_province.select("Province_Key", "Province_Code"), "Province_Code"),
    )
    return rows.select(
        packed_key((F.col("Province_Key"), 0), (F.col("Date_Key"), YEARS)).alias("Economy_ID"),
        "Date_Key",
        "Province_Key",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in PROVINCIAL_MEASURES),
    )


def reading_key() -> Column:
    """Station and hour; unique where a station reports once an hour."""
    at = F.make_timestamp_ntz("Year", "Month", "Day", "Hour_24", F.lit(0), F.lit(0))
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01").cast("timestamp_ntz"), at)
    return packed_key((F.col("Station_Key"), 0), (hours, HOURS))


def hourly_fact(
    readings: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
    dim_province: DataFrame,
    dim_station: DataFrame,
    row_id: Column | None = None,
    keep: tuple[str, ...] = ("Month", "Day"),
    salts: int | None = None,
) -> DataFrame:
    """Readings with their four keys. ``keep`` columns ride along for the physical partitions.

    Year, hour and province dimensions are small. Stations have no size bound, and one station may
    hold much of the data: their lookup takes ``salts``. ``row_id`` gives Monitoring_ID where station and
    hour do not identify a reading.
    """
    rows = star(
        readings,
        (dates.select("Date_Key"), "Date_Key"),
        (hours.select("Time_Key", "Hour_24"), "Hour_24"),
        (dim_province.select("Province_Key", "Province_Code"), "Province_Code"),
    )
    spread = row_id if row_id is not None else F.struct("Month", "Day", "Hour_24")
    places = dim_station.select("Station_Key", "Station_Code")
    rows = spread_lookup(rows, places, "Station_Code", spread, salts=salts)
    return rows.select(
        (row_id if row_id is not None else reading_key()).cast("long").alias("Monitoring_ID"),
        "Date_Key",
        "Time_Key",
        "Province_Key",
        "Station_Key",
        *READINGS,
        "AQI_Index",
        "AQI_Category",
        "Is_Exceeding_QCVN",
        *keep,
    )


def station_rows(stations: DataFrame, dim_province: DataFrame) -> DataFrame:
    """Staged stations with the key of their province; stations of unknown provinces are lost."""
    return stations.join(dim_province.select("Province_Key", "Province_Code"), "Province_Code").select(
        "Station_Code", "Station_Name", "Province_Key", "Station_Type", "Latitude", "Longitude", "Is_Active"
    )


def with_air_index(readings: DataFrame) -> DataFrame:
    """Adds AQI_Index, AQI_Category and Is_Exceeding_QCVN to raw readings."""
    from ..functions import air

    return (
        readings.withColumn("AQI_Index", air.aqi(F.col("PM25_ug_m3"), F.col("NO2_ug_m3")))
        .withColumn("AQI_Category", air.aqi_category(F.col("AQI_Index")))
        .withColumn("Is_Exceeding_QCVN", air.is_exceeding(F.col("PM25_ug_m3")))
    )
