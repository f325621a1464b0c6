"""Column types of the staging files, as DDL strings."""

NATIONAL = (
    "Year int, CO2_MtCO2e decimal(18,4), CO2_Per_Capita_Tonnes decimal(18,6), GDP_USD decimal(18,2), "
    "Methane_MtCO2e decimal(18,4), Renewable_Energy_Pct decimal(5,2), Total_GHG_MtCO2e decimal(18,4)"
)
SECTORS = (
    "Year int, Sector_Code string, Sector_Name_EN string, Sector_Name_VI string, Sector_Category string, "
    "Gas string, Source string, Emissions_MtCO2e decimal(18,4)"
)
PROVINCIAL = (
    "Year int, Province_Code string, Province_Name string, GRDP_Billion_VND decimal(18,2), Population bigint, "
    "Industrial_Output_Billion_VND decimal(18,2), Forest_Coverage_Pct decimal(5,2), "
    "Estimated_Carbon_Tonnes decimal(18,4), Decoupling_Index decimal(18,4)"
)
PROVINCES = (
    "Province_Code string, Province_Name string, Province_Name_Ascii string, Region string, "
    "Economic_Zone string, Area_Km2 decimal(10,2), Is_Industrial_Hub boolean"
)
STATIONS = (
    "Station_Code string, Station_Name string, Province_Code string, Province_Name string, "
    "Station_Type string, Latitude decimal(9,6), Longitude decimal(9,6), Is_Active boolean"
)
HOURLY = (
    "Date_Key int, Year int, Month short, Day short, Hour_24 short, Station_Code string, Province_Code string, "
    "CO2_ppm decimal(8,2), CO_mg_m3 decimal(6,2), NO2_ug_m3 decimal(6,2), SO2_ug_m3 decimal(6,2), "
    "PM25_ug_m3 decimal(6,2), PM10_ug_m3 decimal(6,2), AQI_Index int, AQI_Category string, "
    "Is_Exceeding_QCVN boolean"
)

# What a blank cell becomes; columns not named keep NULL.
PROVINCIAL_BLANKS = {
    "GRDP_Billion_VND": 0, "Population": 0, "Industrial_Output_Billion_VND": 0,
    "Forest_Coverage_Pct": 0, "Estimated_Carbon_Tonnes": 0, "Decoupling_Index": 0,
}
PROVINCE_BLANKS = {"Area_Km2": 0}
