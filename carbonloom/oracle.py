"""The same queries as plain SQL over the given tables, written for DuckDB.

Shared tables are common table expressions; :func:`sql` puts the needed ones in front of a query.
Doubles become decimals before they are summed; ratios are then plain double arithmetic.
"""

from __future__ import annotations

from . import constants as k
from .plans import standin

CTES: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLES: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Upper bounds of the bands, written out: only the labels come from the fixed values.
PLAN_YEARS = (1975, 1980, 1985, 1990, 1995, 2000, 2005, 2010, 2015, 2020, 2025, 2030, 2035, 2040, 2045)
POLICY_YEARS = (1985, 2020, 2030)
BUCKET_HOURS = (5, 9, 15, 19)
AQI_BOUNDS, AQI_COLOR_BOUNDS = (50, 100, 150, 200), (50, 100, 150, 200, 300)


def upto(expr: str, bounds, bands, after: str) -> str:
    whens = " ".join(f"WHEN {expr} <= {bound} THEN {quoted(label)}" for bound, (_, label) in zip(bounds, bands, strict=True))
    return f"CASE {whens} ELSE {quoted(after)} END"


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,4))"


def ratio4(n: str, d: str) -> str:
    """n / d half-up at 4 places in exact integer arithmetic, 0 unless d > 0, as DOUBLE."""
    big_n, big_d = f"CAST({n} * 10000 AS HUGEINT)", f"CAST({d} * 10000 AS HUGEINT)"
    return (
        f"CASE WHEN {d} > 0 THEN CAST((2 * {big_n} * 10000 + {big_d}) // (2 * {big_d}) AS DOUBLE) / 10000 ELSE 0.0 END"
    )


def ratio4_dec(n: str, d: str) -> str:
    """The same as DECIMAL, for summing."""
    return f"CAST({ratio4(n, d)} AS DECIMAL(18,4))"


def cte(name: str, *needs: str):
    def add(text: str) -> None:
        CTES[name] = (needs, text)

    return add


def sql(name: str, needs: tuple[str, ...], text: str) -> None:
    ordered: list[str] = []

    def visit(table: str) -> None:
        if table not in ordered:
            for inner in CTES[table][0]:
                visit(inner)
            ordered.append(table)

    for table in needs:
        visit(table)
    head = "WITH " + ",\n".join(f"{t} AS ({CTES[t][1]})" for t in ordered) + "\n" if ordered else ""
    ORACLES[name] = head + text.strip()


def decade(year: str) -> str:
    return f"CAST(floor({year} / 10) * 10 AS INTEGER) || 's'"


TAPIO, GREEN, STATUS, COLOR = k.TAPIO_LABELS, k.GREEN_LABELS, k.STATUS_LABELS, k.STATUS_COLORS


def tapio(x: str) -> str:
    return (
        f"CASE WHEN {x} < 0 THEN {quoted(TAPIO[0])} WHEN {x} BETWEEN 0 AND 0.8 THEN {quoted(TAPIO[1])} "
        f"WHEN {x} BETWEEN 0.8 AND 1.2 THEN {quoted(TAPIO[2])} ELSE {quoted(TAPIO[3])} END"
    )


def green(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 100 THEN {quoted(GREEN[0])} WHEN {x} >= 70 THEN {quoted(GREEN[1])} "
        f"ELSE {quoted(GREEN[2])} END"
    )


def status(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN {quoted(STATUS[0])} WHEN {x} < 0 THEN {quoted(STATUS[1])} "
        f"WHEN {x} BETWEEN 0 AND 0.8 THEN {quoted(STATUS[2])} WHEN {x} > 0.8 AND {x} <= 1.2 THEN {quoted(STATUS[3])} "
        f"ELSE {quoted(STATUS[4])} END"
    )


def color(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN {quoted(COLOR[0])} WHEN {x} < 0 THEN {quoted(COLOR[1])} "
        f"WHEN {x} BETWEEN 0 AND 0.8 THEN {quoted(COLOR[2])} ELSE {quoted(COLOR[3])} END"
    )


def aqi_color(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '{k.AQI_COLOR_NONE}' ELSE {upto(x, AQI_COLOR_BOUNDS, k.AQI_COLORS, k.AQI_COLOR_AFTER)} END"


def mean(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0)"


def strip_marks(text: str, prefix: bool = True) -> str:
    plain = f"strip_accents(replace(replace({text}, 'đ', 'd'), 'Đ', 'D'))"
    key = f"lower(regexp_replace({plain}, '[^a-zA-Z0-9]', '', 'g'))"
    return f"regexp_replace({key}, '^tp', '')" if prefix else key


# --- shared tables -------------------------------------------------------------

cte("dates")(f"""
SELECT CAST(y AS BIGINT) AS Date_Key, CAST(y AS BIGINT) AS Year, {decade('y')} AS Decade,
  {upto('y', PLAN_YEARS, k.PLAN_PHASES, k.PLAN_PHASE_AFTER)} AS Five_Year_Plan_Phase, y IN (2030, 2050) AS Is_Target_Milestone
FROM range(1970, 2051) t(y)""")

cte("hours")(f"""
SELECT CAST(h AS BIGINT) AS Time_Key, CAST(h AS BIGINT) AS Hour_24,
  lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS Hour_Label,
  {upto('h', BUCKET_HOURS, k.TIME_BUCKETS, k.TIME_BUCKET_AFTER)} AS Time_Bucket, h IN (7, 8, 9, 17, 18, 19) AS Is_Rush_Hour
FROM range(0, 24) t(h)""")

cte("provinces")("""
SELECT CAST(n_nationkey + 1 AS BIGINT) AS Province_Key, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS Province_Code,
  n_name AS Province_Name, lower(n_name) AS Province_Name_Ascii, r_name AS Region,
  'ZONE_' || CAST(n_nationkey % 3 AS VARCHAR) AS Economic_Zone,
  CAST(1000 + 10 * n_nationkey AS DECIMAL(10,2)) AS Area_Km2, n_nationkey % 2 = 0 AS Is_Industrial_Hub
FROM nation JOIN region ON n_regionkey = r_regionkey""")

cte("sectors")("""
SELECT CAST(row_number() OVER (ORDER BY substr(md5(c), 1, 3), c) AS BIGINT) AS Sector_Key, c AS Sector_Code,
  upper(substr(c, 1, 1)) || lower(substr(c, 2)) AS Sector_Name_EN, 'Ngành ' || lower(c) AS Sector_Name_VI,
  CASE WHEN c IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'Basic' ELSE 'Sized' END AS Sector_Category,
  CASE WHEN c = 'TOT' THEN 'Scope 1/2/3' WHEN c IN ('PROMO', 'LARGE') THEN 'Scope 1' END AS Scope_Type
FROM (SELECT DISTINCT p_type AS c FROM part UNION ALL SELECT 'TOT')""")

cte("stations", "provinces")(f"""
SELECT user_id + 1 AS Station_Key, 'ST-' || user_id AS Station_Code, 'Trạm ' || user_id AS Station_Name, Province_Key,
  CASE user_id % 3 WHEN 0 THEN {quoted(standin.STATION_TYPES[0])} WHEN 1 THEN {quoted(standin.STATION_TYPES[1])}
    ELSE {quoted(standin.STATION_TYPES[2])} END AS Station_Type,
  CAST(8 + (user_id % 1000) * 0.01 AS DECIMAL(9,6)) AS Latitude,
  CAST(102 + (user_id % 1000) * 0.01 AS DECIMAL(9,6)) AS Longitude, user_id % 10 <> 0 AS Is_Active
FROM (SELECT DISTINCT user_id FROM events) u
JOIN provinces p ON p.Province_Code = lpad(CAST(user_id % 25 AS VARCHAR), 2, '0')""")

cte("order_units")(f"SELECT l_orderkey, SUM({money('l_quantity')}) AS q FROM lineitem GROUP BY l_orderkey")

cte("economy", "order_units")(f"""
SELECT Year, Province_Code, GRDP_Billion_VND, Population, Industrial_Output_Billion_VND, Forest_Coverage_Pct,
  Estimated_Carbon_Tonnes,
  round(CAST(Estimated_Carbon_Tonnes AS DOUBLE) / NULLIF(CAST(GRDP_Billion_VND AS DOUBLE), 0), 4) AS Decoupling_Index
FROM (
  SELECT year(o_orderdate) AS Year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS Province_Code,
    SUM({money('o_totalprice')}) AS GRDP_Billion_VND, COUNT(DISTINCT o_custkey) AS Population,
    COALESCE(SUM(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {money('o_totalprice')} END), 0)
      AS Industrial_Output_Billion_VND,
    CAST(round(100.0 * COUNT(*) FILTER (WHERE o_orderstatus = 'F') / COUNT(*), 2) AS DECIMAL(5,2)) AS Forest_Coverage_Pct,
    COALESCE(SUM(q) * 250000, 0) AS Estimated_Carbon_Tonnes
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN order_units ON o_orderkey = l_orderkey
  GROUP BY 1, 2)""")

cte("sector_emissions")(f"""
SELECT year(l_shipdate) AS Year, p_type AS Sector_Code, l_returnflag AS Gas,
  SUM({money('l_extendedprice')}) AS Emissions_MtCO2e
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
UNION ALL
SELECT year(l_shipdate), 'TOT', l_returnflag, SUM({money('l_extendedprice')})
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")

cte("national")(f"""
SELECT Year, CO2_MtCO2e, Methane_MtCO2e, GDP_USD, Total_GHG_MtCO2e,
  CAST(round(CAST(ren AS DOUBLE) * 100 / CAST(whole AS DOUBLE), 2) AS DECIMAL(5,2)) AS Renewable_Energy_Pct
FROM (
  SELECT year(o_orderdate) AS Year,
    SUM({money('o_totalprice')}) FILTER (WHERE o_orderpriority = '1-URGENT') AS CO2_MtCO2e,
    SUM({money('o_totalprice')}) FILTER (WHERE o_orderpriority = '2-HIGH') AS GDP_USD,
    SUM({money('o_totalprice')}) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS Methane_MtCO2e,
    SUM({money('o_totalprice')}) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS ren,
    SUM({money('o_totalprice')}) FILTER (WHERE o_orderpriority = '5-LOW') AS Total_GHG_MtCO2e,
    SUM({money('o_totalprice')}) AS whole
  FROM orders GROUP BY 1)""")

cte("national_fact", "sector_emissions", "dates", "sectors", "national")("""
SELECT (Sector_Key * 10000 + Date_Key) * 16 + CASE Gas WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS Emission_ID,
  Date_Key, Sector_Key, Gas, COALESCE(Emissions_MtCO2e, 0) AS Emissions_MtCO2e, CO2_MtCO2e, Methane_MtCO2e,
  CASE WHEN e.Sector_Code = 'TOT' THEN Renewable_Energy_Pct END AS Renewable_Energy_Pct,
  CASE WHEN e.Sector_Code = 'TOT' THEN GDP_USD END AS GDP_USD
FROM sector_emissions e JOIN dates d ON e.Year = d.Year JOIN sectors s ON e.Sector_Code = s.Sector_Code
LEFT JOIN national n ON e.Year = n.Year""")

cte("national_view", "national_fact")("""
SELECT f.Emission_ID, f.Date_Key, d.Year, d.Decade, d.Five_Year_Plan_Phase, f.Sector_Key, s.Sector_Code,
  s.Sector_Name_VI, s.Sector_Category, COALESCE(s.Scope_Type, 'Scope 1 & 2') AS Scope_Type, f.Gas, f.Emissions_MtCO2e,
  f.CO2_MtCO2e, f.Methane_MtCO2e, f.Renewable_Energy_Pct,
  CASE WHEN s.Sector_Code = 'TOT' THEN f.GDP_USD END AS GDP_USD, f.GDP_USD AS Raw_GDP_USD_Unsafe
FROM national_fact f JOIN dates d ON f.Date_Key = d.Date_Key JOIN sectors s ON f.Sector_Key = s.Sector_Key""")

cte("provincial_fact", "economy", "dates", "provinces")("""
SELECT Province_Key * 10000 + Date_Key AS Economy_ID, Date_Key, Province_Key, GRDP_Billion_VND, Population,
  Industrial_Output_Billion_VND, Forest_Coverage_Pct, Estimated_Carbon_Tonnes,
  COALESCE(Decoupling_Index, 0) AS Decoupling_Index
FROM economy e JOIN dates d ON e.Year = d.Year JOIN provinces p ON e.Province_Code = p.Province_Code""")

cte("provincial_view", "provincial_fact")(f"""
SELECT f.Economy_ID, f.Date_Key, d.Year, d.Decade, f.Province_Key, p.Province_Code, p.Province_Name,
  p.Province_Name_Ascii, p.Region, p.Economic_Zone, p.Area_Km2, p.Is_Industrial_Hub, f.GRDP_Billion_VND, f.Population,
  f.Industrial_Output_Billion_VND, f.Forest_Coverage_Pct, f.Estimated_Carbon_Tonnes, f.Decoupling_Index,
  {tapio('f.Decoupling_Index')} AS Decoupling_Status,
  {ratio4('f.Estimated_Carbon_Tonnes', 'f.GRDP_Billion_VND')} AS Carbon_Intensity_Tonnes_Per_Billion_VND,
  {ratio4('f.Estimated_Carbon_Tonnes', 'f.Population')} AS Carbon_Per_Capita_Tonnes,
  {ratio4('f.Estimated_Carbon_Tonnes', 'p.Area_Km2')} AS Carbon_Density_Tonnes_Per_Km2
FROM provincial_fact f JOIN dates d ON f.Date_Key = d.Date_Key JOIN provinces p ON f.Province_Key = p.Province_Key""")

cte("readings")(f"""
SELECT *, {upto('AQI_Index', AQI_BOUNDS, k.AQI_CATEGORIES, k.AQI_CATEGORY_AFTER)} AS AQI_Category,
  PM25_ug_m3 > 50 AS Is_Exceeding_QCVN
FROM (
  SELECT *, CAST(LEAST(GREATEST(round_even(CAST(PM25_ug_m3 AS DOUBLE) * 2.2 + CAST(NO2_ug_m3 AS DOUBLE) * 0.4, 0), 15), 320)
    AS BIGINT) AS AQI_Index
  FROM (
    SELECT event_id, year(ts) AS Date_Key, month(ts) AS Month, day(ts) AS Day, hour(ts) AS Hour_24,
      'ST-' || user_id AS Station_Code, lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS Province_Code,
      CAST(400 + value AS DECIMAL(8,2)) AS CO2_ppm, CAST(kk * 0.01 AS DECIMAL(6,2)) AS CO_mg_m3,
      CAST(kk AS DECIMAL(6,2)) AS NO2_ug_m3, CAST(kk + 1 AS DECIMAL(6,2)) AS SO2_ug_m3,
      CAST(value AS DECIMAL(6,2)) AS PM25_ug_m3, CAST(CAST(value AS DECIMAL(6,2)) * 2 AS DECIMAL(6,2)) AS PM10_ug_m3
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS kk FROM events)))""")

cte("hourly_fact", "readings", "dates", "hours", "provinces", "stations")("""
SELECT event_id AS Monitoring_ID, d.Date_Key, t.Time_Key, p.Province_Key, s.Station_Key, CO2_ppm, CO_mg_m3, NO2_ug_m3,
  SO2_ug_m3, PM25_ug_m3, PM10_ug_m3, AQI_Index, AQI_Category, Is_Exceeding_QCVN, Month, Day
FROM readings r JOIN dates d ON r.Date_Key = d.Date_Key JOIN hours t ON r.Hour_24 = t.Hour_24
JOIN provinces p ON r.Province_Code = p.Province_Code JOIN stations s ON r.Station_Code = s.Station_Code""")

cte("hourly_view", "hourly_fact")(f"""
SELECT f.Monitoring_ID, f.Date_Key, d.Year, f.Time_Key, t.Hour_24, t.Hour_Label, t.Time_Bucket, t.Is_Rush_Hour,
  f.Province_Key, p.Province_Code, p.Province_Name, p.Region, f.Station_Key, s.Station_Code, s.Station_Name,
  s.Station_Type, s.Latitude, s.Longitude, f.CO2_ppm, f.CO_mg_m3, f.NO2_ug_m3, f.SO2_ug_m3, f.PM25_ug_m3,
  f.PM10_ug_m3, f.AQI_Index, f.AQI_Category, f.Is_Exceeding_QCVN,
  CASE WHEN f.Is_Exceeding_QCVN THEN {quoted(k.LIMIT_LABELS[0])} ELSE {quoted(k.LIMIT_LABELS[1])} END AS QCVN_Compliance_Label
FROM hourly_fact f JOIN dates d ON f.Date_Key = d.Date_Key JOIN hours t ON f.Time_Key = t.Time_Key
JOIN provinces p ON f.Province_Key = p.Province_Key JOIN stations s ON f.Station_Key = s.Station_Key""")


def doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


MEASURED = (
    "GRDP_Billion_VND", "Industrial_Output_Billion_VND", "Forest_Coverage_Pct", "Estimated_Carbon_Tonnes",
    "Decoupling_Index",
)
GASES = ("CO2_ppm", "CO_mg_m3", "NO2_ug_m3", "SO2_ug_m3", "PM25_ug_m3", "PM10_ug_m3")
NATIONAL = ("Emissions_MtCO2e", "CO2_MtCO2e", "Methane_MtCO2e", "Renewable_Energy_Pct", "GDP_USD")

# --- analytic queries --------------------------------------------------------

sql("top_emitters_latest_year", ("provincial_view",), f"""
SELECT Year, Province_Code, Province_Name, Region, Economic_Zone, Is_Industrial_Hub,
  CAST(Estimated_Carbon_Tonnes AS DOUBLE) AS Carbon_Tonnes, {doubles('GRDP_Billion_VND', 'Decoupling_Index')},
  {green('Decoupling_Index')} AS Decoupling_Status,
  dense_rank() OVER (ORDER BY Estimated_Carbon_Tonnes DESC) AS Emission_Rank
FROM provincial_view WHERE Year = (SELECT MAX(Year) FROM provincial_view)
ORDER BY Estimated_Carbon_Tonnes DESC, Province_Code LIMIT 10""")

sql("decade_trend", ("national_view",), f"""
SELECT Decade, COUNT(DISTINCT Year) AS Years_Count, round({mean('Renewable_Energy_Pct')}, 2) AS Avg_Renewable_Pct,
  round(CAST(SUM(CO2_MtCO2e) AS DOUBLE), 2) AS Total_CO2_MtCO2e,
  round({mean('GDP_USD')} / 1000000000.0, 2) AS Avg_GDP_Billion_USD,
  round(CASE WHEN {mean('GDP_USD')} > 0 THEN (CAST(SUM(CO2_MtCO2e) AS DOUBLE) * 1000000.0) / ({mean('GDP_USD')} / 1000.0)
    ELSE 0 END, 4) AS Carbon_Intensity_Tonnes_Per_1k_USD
FROM national_view WHERE Sector_Code = 'TOT' GROUP BY Decade""")

sql("sector_share_by_phase", ("national_view",), """
SELECT Five_Year_Plan_Phase, Sector_Category, Sector_Name_VI,
  round(CAST(SUM(Emissions_MtCO2e) AS DOUBLE), 2) AS Period_Total_Emissions_MtCO2e,
  round(CAST(SUM(Emissions_MtCO2e) AS DOUBLE) / COUNT(Emissions_MtCO2e), 2) AS Annual_Avg_Emissions_MtCO2e,
  round(CAST(SUM(Emissions_MtCO2e) AS DOUBLE)
    / NULLIF(CAST(SUM(SUM(Emissions_MtCO2e)) OVER (PARTITION BY Five_Year_Plan_Phase) AS DOUBLE), 0) * 100, 2)
    AS Sector_Contribution_Pct
FROM national_view WHERE Sector_Code <> 'TOT' AND Gas = 'N' AND Year >= 1996
GROUP BY Five_Year_Plan_Phase, Sector_Category, Sector_Name_VI""")

sql("quadrant_matrix", ("provincial_view",), f"""
SELECT Province_Code, Province_Name, Region, {doubles('GRDP_Billion_VND', 'Estimated_Carbon_Tonnes', 'Decoupling_Index')},
  CASE WHEN g >= bg AND c < bc THEN {quoted(k.QUADRANTS[0])} WHEN g >= bg AND c >= bc THEN {quoted(k.QUADRANTS[1])}
    WHEN g < bg AND c >= bc THEN {quoted(k.QUADRANTS[2])} ELSE {quoted(k.QUADRANTS[3])} END AS Quadrant_Classification
FROM (SELECT *, CAST(GRDP_Billion_VND AS DOUBLE) AS g, CAST(Estimated_Carbon_Tonnes AS DOUBLE) AS c
      FROM provincial_view WHERE Year = 2000)
CROSS JOIN (SELECT {mean('GRDP_Billion_VND')} AS bg, {mean('Estimated_Carbon_Tonnes')} AS bc
            FROM provincial_view WHERE Year = 2000)""")

# --- dimensions and views ------------------------------------------------------

sql("dim_date", ("dates",), f"""
SELECT d.*, COALESCE(n, 0) AS Lines, CAST(u AS DOUBLE) AS Units
FROM dates d LEFT JOIN (SELECT year(l_shipdate) AS y, COUNT(*) AS n, SUM({money('l_quantity')}) AS u
                        FROM lineitem GROUP BY 1) ON y = Year""")

sql("dim_time_of_day", ("hours",), """
SELECT h.*, COALESCE(n, 0) AS Readings
FROM hours h LEFT JOIN (SELECT hour(ts) AS k, COUNT(*) AS n FROM events GROUP BY 1) ON k = Time_Key""")

sql("vw_dim_date", ("dates",), f"""
SELECT d.*, make_date(Year, 12, 31) AS Year_Date,
  CASE WHEN Year < 1986 THEN {quoted(k.POLICY_PERIODS[0][1])} WHEN Year <= 2020 THEN {quoted(k.POLICY_PERIODS[1][1])}
    WHEN Year <= 2030 THEN {quoted(k.POLICY_PERIODS[2][1])} ELSE {quoted(k.POLICY_PERIOD_AFTER)} END AS Policy_Period,
  CAST(Year < 1986 AS BIGINT) AS Is_Pre_DoiMoi, CAST(Year >= 1986 AS BIGINT) AS Is_DoiMoi_Era,
  CAST(Year IN (2030, 2050) AS BIGINT) AS Is_NetZero_Milestone, COALESCE(n, 0) AS Orders
FROM dates d LEFT JOIN (SELECT year(o_orderdate) AS y, COUNT(*) AS n FROM orders GROUP BY 1) ON y = Year""")

sql("vw_dim_province", ("provinces",), f"""
SELECT p.* REPLACE (CAST(Area_Km2 AS DOUBLE) AS Area_Km2),
  CASE WHEN Is_Industrial_Hub THEN {quoted(k.HUB_LABELS[0])} ELSE {quoted(k.HUB_LABELS[1])} END AS Industrial_Hub_Label,
  CASE Region WHEN 'AFRICA' THEN 'Miền Bắc' WHEN 'AMERICA' THEN 'Miền Trung' WHEN 'ASIA' THEN 'Miền Nam'
    ELSE 'Khác' END AS Macro_Region, COALESCE(n, 0) AS Customers
FROM provinces p LEFT JOIN (SELECT c_nationkey + 1 AS nk, COUNT(*) AS n FROM customer GROUP BY 1) ON nk = Province_Key""")

sql("macro_region_variants", (), """
SELECT Region, COUNT(*) AS Documents,
  CASE Region WHEN 'En và src1' THEN 'Miền Bắc' WHEN 'FR VÀ SRC2' THEN 'Miền Trung' WHEN 'De & SRC3' THEN 'Miền Nam'
    ELSE 'Khác' END AS Macro_Region,
  CASE lower(Region) WHEN 'en & src1' THEN 'Miền Bắc' WHEN 'fr & src2' THEN 'Miền Trung' ELSE 'Khác' END
    AS Macro_Region_Normalised
FROM (SELECT upper(lang[1]) || lower(lang[2:]) || ' & ' || upper(source) AS Region FROM documents)
GROUP BY Region""")

sql("vw_dim_sector", ("sectors",), """
SELECT Sector_Key, Sector_Code, Sector_Name_EN, Sector_Name_VI, Sector_Category,
  COALESCE(Scope_Type, 'Scope 1 & 2') AS Scope_Type,
  COALESCE(Scope_Type, 'Scope 1 & 2') || ' > ' || Sector_Category || ' > ' || Sector_Name_VI AS Sector_Hierarchy_Path,
  CAST(Sector_Code = 'TOT' AS BIGINT) AS Is_Total_Sector, COALESCE(n, 0) AS Parts
FROM sectors LEFT JOIN (SELECT p_type, COUNT(*) AS n FROM part GROUP BY 1) ON p_type = Sector_Code""")

sql("vw_fact_national", ("national_view",), """
SELECT * REPLACE (CAST(Emissions_MtCO2e AS DOUBLE) AS Emissions_MtCO2e, CAST(CO2_MtCO2e AS DOUBLE) AS CO2_MtCO2e,
  CAST(Methane_MtCO2e AS DOUBLE) AS Methane_MtCO2e, CAST(Renewable_Energy_Pct AS DOUBLE) AS Renewable_Energy_Pct,
  CAST(GDP_USD AS DOUBLE) AS GDP_USD, CAST(Raw_GDP_USD_Unsafe AS DOUBLE) AS Raw_GDP_USD_Unsafe)
FROM national_view""")

sql("vw_fact_provincial", ("provincial_view",), """
SELECT * REPLACE (CAST(Area_Km2 AS DOUBLE) AS Area_Km2, CAST(GRDP_Billion_VND AS DOUBLE) AS GRDP_Billion_VND,
  CAST(Industrial_Output_Billion_VND AS DOUBLE) AS Industrial_Output_Billion_VND,
  CAST(Forest_Coverage_Pct AS DOUBLE) AS Forest_Coverage_Pct,
  CAST(Estimated_Carbon_Tonnes AS DOUBLE) AS Estimated_Carbon_Tonnes)
FROM provincial_view""")

sql("vw_dim_station", ("stations",), f"""
SELECT Station_Key, Station_Code, Station_Name, s.Province_Key, Province_Code, Province_Name, Region, Economic_Zone,
  Station_Type, {doubles('Latitude', 'Longitude')}, Is_Active
FROM stations s JOIN provinces p ON s.Province_Key = p.Province_Key""")

sql("vw_dim_time_of_day", ("hours",), f"""
SELECT h.*, CASE WHEN Is_Rush_Hour THEN {quoted(k.RUSH_LABELS[0])} ELSE {quoted(k.RUSH_LABELS[1])} END AS Rush_Hour_Label,
  COALESCE(n, 0) AS Readings, round(CAST(v AS DOUBLE), 4) AS Total_Value
FROM hours h LEFT JOIN (SELECT hour(ts) AS k, COUNT(*) AS n, SUM({money('value')}) AS v FROM events GROUP BY 1)
  ON k = Time_Key""")

sql("vw_fact_hourly", ("hourly_view",), "SELECT * REPLACE ("
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("Latitude", "Longitude", *GASES)) + ") FROM hourly_view")

# --- facts ---------------------------------------------------------------------

sql("national_fact", ("national_fact",),
    f"SELECT Emission_ID, Date_Key, Sector_Key, Gas, {doubles(*NATIONAL)} FROM national_fact")
sql("provincial_fact", ("provincial_fact",),
    f"SELECT Economy_ID, Date_Key, Province_Key, Population, {doubles(*MEASURED)} FROM provincial_fact")
sql("hourly_fact", ("hourly_fact",), "SELECT * REPLACE ("
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in GASES) + ") FROM hourly_fact")

# --- projections -----------------------------------------------------------------

sql("decade_label", (), f"""
SELECT {decade('year(l_shipdate)')} AS Decade, COUNT(*) AS Lines, CAST(SUM({money('l_quantity')}) AS DOUBLE) AS Units
FROM lineitem GROUP BY 1""")

sql("plan_phase_band", (), f"""
SELECT {upto('year(o_orderdate)', PLAN_YEARS, k.PLAN_PHASES, k.PLAN_PHASE_AFTER)} AS Five_Year_Plan_Phase,
  {upto('year(o_orderdate)', POLICY_YEARS, k.POLICY_PERIODS, k.POLICY_PERIOD_AFTER)} AS Policy_Period, COUNT(*) AS Orders,
  CAST(SUM({money('o_totalprice')}) AS DOUBLE) AS Total
FROM orders GROUP BY 1, 2""")

sql("hour_bucket_profile", (), f"""
SELECT {upto('hour(ts)', BUCKET_HOURS, k.TIME_BUCKETS, k.TIME_BUCKET_AFTER)} AS Time_Bucket,
  hour(ts) IN (7, 8, 9, 17, 18, 19) AS Is_Rush_Hour, COUNT(*) AS Readings,
  CAST(SUM({money('value')}) AS DOUBLE) AS Total_Value
FROM events GROUP BY 1, 2""")

sql("overcount_guard", ("sector_emissions", "national"), """
SELECT Sector_Code, CAST(SUM(CASE WHEN Sector_Code = 'TOT' THEN GDP_USD END) AS DOUBLE) AS GDP_Guarded,
  CAST(SUM(GDP_USD) AS DOUBLE) AS GDP_Unsafe, COUNT(*) AS Fact_Rows
FROM sector_emissions e LEFT JOIN national n ON e.Year = n.Year GROUP BY Sector_Code""")

sql("intensity_ratios", (), f"""
SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(SUM({ratio4_dec(money('l_extendedprice'), money('l_quantity'))}) AS DOUBLE) AS Price_Per_Unit,
  CAST(SUM({ratio4_dec(money('l_tax'), money('l_discount'))}) AS DOUBLE) AS Tax_Per_Discount,
  COUNT(*) FILTER (WHERE {money('l_discount')} = 0) AS Zero_Denominators
FROM lineitem GROUP BY 1""")

sql("tapio_band", (), f"""
SELECT {tapio('x')} AS Tapio, {green('x * 100')} AS Green, {status('x')} AS Status, {color('x')} AS Color, COUNT(*) AS Lines
FROM (SELECT (l_tax - CAST(0.02 AS DOUBLE)) / NULLIF(l_discount, 0) AS x FROM lineitem) GROUP BY 1, 2, 3, 4""")

sql("code_map_default", (), """
SELECT COUNT(*) AS Parts,
  CASE p_type WHEN 'ECONOMY' THEN 'ENG' WHEN 'LARGE' THEN 'ELE' WHEN 'MEDIUM' THEN 'IND' WHEN 'PROMO' THEN 'AGR'
    ELSE 'OTH' END AS Sector_Code, p_type AS Sector_Name_EN,
  CASE p_type WHEN 'ECONOMY' THEN 'Năng lượng & Khai khoáng' WHEN 'LARGE' THEN 'Sản xuất Điện & Nhiệt'
    WHEN 'MEDIUM' THEN 'Công nghiệp Chế biến & Xây dựng' WHEN 'PROMO' THEN 'Nông nghiệp & Trồng lúa nước'
    ELSE p_type END AS Sector_Name_VI,
  CASE p_type WHEN 'ECONOMY' THEN 'Energy' WHEN 'LARGE' THEN 'Energy' WHEN 'MEDIUM' THEN 'Industry'
    WHEN 'PROMO' THEN 'Agriculture' ELSE 'Other' END AS Sector_Category
FROM part GROUP BY p_type""")

cte("text_lines")("SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents")

sql("blank_rule", (), """
WITH text_lines AS (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents),
cells AS (SELECT lang, cell, ltrim(cell, '0') AS digits FROM (SELECT lang, regexp_extract(line, '([0-9]+)', 1) AS cell FROM text_lines)),
numbers AS (SELECT lang, cell, length(digits) > 38 AS unfit,
  CASE WHEN length(cell) > 0 AND length(digits) <= 38 THEN CAST('0' || digits AS HUGEINT) END AS n FROM cells)
SELECT lang, COUNT(n) AS Numbers, COUNT(*) FILTER (WHERE unfit) AS Unfit, COUNT(*) FILTER (WHERE NOT unfit) AS Numbers_Or_Zero,
  CAST(SUM(COALESCE(n, 0) % 1000003) AS BIGINT) AS Total, COUNT(*) FILTER (WHERE cell = '1') AS Flags
FROM numbers GROUP BY lang""")

sql("csv_quoted_cells", (), """
SELECT c_custkey AS code, c_name || ' "' || c_nationkey || '", x' AS name, CAST(c_nationkey AS BIGINT) AS nation
FROM customer""")

sql("bulk_lines_split", ("text_lines",), """
SELECT lang, COUNT(*) FILTER (WHERE len(f) >= 3) AS kept, COUNT(*) FILTER (WHERE len(f) < 3) AS dropped,
  CAST(SUM(CASE WHEN len(f) >= 3 THEN length(f[2]) + length(f[3]) END) AS BIGINT) AS field_chars
FROM (SELECT lang, string_split(line, ',') AS f FROM text_lines) GROUP BY lang""")

# --- joins and sets --------------------------------------------------------------

sql("ri_orphans", (), """
SELECT 'missing' AS side, doc_id AS key FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'extra', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")

sql("ri_reference_counts", (), """
SELECT (SELECT COUNT(DISTINCT c_custkey) FROM customer) AS dim_codes,
  (SELECT COUNT(DISTINCT user_id) FROM events) AS fact_codes,
  (SELECT COUNT(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) AS orphan_codes,
  (SELECT COUNT(DISTINCT c_custkey) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)) AS unused_codes,
  (SELECT COUNT(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) = 0 AS passed""")

sql("lookup_losses", (), """
SELECT 'label' AS lookup, COUNT(*) AS rows_lost FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'order', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'part', COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'station', COUNT(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT user_id FROM events)""")

cte("coverage")("""
SELECT CAST(year AS BIGINT) AS year, bool_or(s = 'o') AS in_orders, bool_or(s = 'l') AS in_lines,
  bool_or(s = 'r') AS in_readings
FROM (SELECT DISTINCT year(o_orderdate) AS year, 'o' AS s FROM orders UNION ALL
      SELECT DISTINCT year(l_shipdate), 'l' FROM lineitem UNION ALL SELECT DISTINCT year(ts) - 24, 'r' FROM events)
GROUP BY year""")
sql("common_years", ("coverage",), "SELECT * FROM coverage")
sql("year_consistency", ("coverage",), """
SELECT MIN(year) FILTER (WHERE in_orders) AS first_orders, MAX(year) FILTER (WHERE in_orders) AS last_orders,
  MIN(year) FILTER (WHERE in_lines) AS first_lines, MAX(year) FILTER (WHERE in_lines) AS last_lines,
  MIN(year) FILTER (WHERE in_readings) AS first_readings, MAX(year) FILTER (WHERE in_readings) AS last_readings,
  COUNT(*) FILTER (WHERE in_orders AND in_lines AND in_readings) AS common_year_count,
  COUNT(*) FILTER (WHERE in_orders AND in_lines AND in_readings) >= 1
    AND COUNT(*) FILTER (WHERE in_orders AND in_lines AND in_readings AND year IN (1996, 2000)) = 2 AS passed
FROM coverage""")

# --- loads -------------------------------------------------------------------------

sql("scd1_merge", (), """
SELECT s_suppkey + 1 AS Member_Key, s_suppkey AS Member_Code, COALESCE(c_name, s_name) AS Member_Name,
  CAST(COALESCE(c_nationkey, s_nationkey) AS BIGINT) AS Nation,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE s_acctbal END AS Balance, 'Scope 1' AS Scope_Type
FROM supplier LEFT JOIN customer ON s_suppkey = c_custkey
UNION ALL
SELECT (SELECT MAX(s_suppkey) + 1 FROM supplier)
    + row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey),
  c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0 END, NULL
FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")

sql("dense_surrogate_keys", (), """
SELECT c_custkey, c_name, 100 + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) AS Customer_Key
FROM customer""")

sql("idempotent_reload", (), f"""
SELECT Date_Key, origin, COUNT(*) AS Fact_Rows, CAST(SUM(v) AS DOUBLE) AS Total
FROM (SELECT year(o_orderdate) AS Date_Key, 'loaded' AS origin, {money('o_totalprice')} AS v FROM orders
      WHERE year(o_orderdate) NOT IN (SELECT year(l_shipdate) FROM lineitem WHERE year(l_shipdate) >= 2000)
      UNION ALL SELECT year(l_shipdate), 'staged', {money('l_extendedprice')} FROM lineitem WHERE year(l_shipdate) >= 2000)
GROUP BY 1, 2""")

sql("reload_by_staged_years", (), """
SELECT Date_Key, origin, COUNT(*) AS Fact_Rows
FROM (SELECT year(o_orderdate) AS Date_Key, 'loaded' AS origin FROM orders
      WHERE year(o_orderdate) NOT IN (SELECT year(l_shipdate) FROM lineitem WHERE year(l_shipdate) >= 1996)
      UNION ALL SELECT year(l_shipdate), 'staged' FROM lineitem
      WHERE year(l_shipdate) >= 1996 AND year(l_shipdate) % 2 = 0)
GROUP BY 1, 2""")

sql("fact_key_uniqueness", ("national_fact", "provincial_fact", "hourly_fact"), """
SELECT 'national' AS fact, COUNT(*) AS Fact_Rows, COUNT(*) AS Fact_Keys FROM national_fact
UNION ALL SELECT 'provincial', COUNT(*), COUNT(*) FROM provincial_fact
UNION ALL SELECT 'hourly', COUNT(*), COUNT(*) FROM hourly_fact""")

_RULES = (
    ("orders", "o_totalprice > 0", "orders", "o_totalprice <= 0 OR o_totalprice IS NULL"),
    ("orders", "o_orderdate not null", "orders", "o_orderdate IS NULL"),
    ("orders", "status not null", "orders", "o_orderstatus = 'P' OR o_orderstatus IS NULL"),
    ("customer", "c_acctbal >= 0", "customer", "c_acctbal < 0"),
    ("customer", "c_name not null", "customer", "c_name IS NULL"),
    ("supplier", "s_acctbal >= 0", "supplier", "s_acctbal < 0 OR s_acctbal IS NULL"),
    ("lineitem", "l_quantity in 0..100", "lineitem", "l_quantity < 0 OR l_quantity > 100"),
    ("lineitem", "l_extendedprice in 0..100", "lineitem", "l_extendedprice < 0 OR l_extendedprice > 100"),
    ("documents", "quality >= 0", "documents LEFT JOIN labels USING (doc_id)", "quality < 0"),
    ("documents", "quality >= 0 strict", "documents LEFT JOIN labels USING (doc_id)", "quality < 0 OR quality IS NULL"),
)
sql("constraint_violations", (), "\nUNION ALL ".join(
    f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, COUNT(*) AS violations, COUNT(*) = 0 AS passed "
    f"FROM {source} WHERE {broken}" for dataset, rule, source, broken in _RULES))

sql("audit_latest_state", (), """
SELECT log_id, lone AS lone_event_id, arg_min(package, ord) AS package, arg_min(task, ord) AS task,
  arg_max(status, ord) AS status,
  CAST(arg_max(rows_processed, ord) FILTER (WHERE status <> 'RUNNING' AND rows_processed IS NOT NULL) AS BIGINT)
    AS rows_processed,
  NULLIF(arg_max(COALESCE(error, ''), ord) FILTER (WHERE status <> 'RUNNING'), '') AS error,
  CAST((epoch_us(MAX(ts) FILTER (WHERE status <> 'RUNNING'))
    - epoch_us(COALESCE(MIN(ts) FILTER (WHERE status = 'RUNNING'), MIN(ts)))) // 1000000 AS BIGINT) AS duration_s
FROM (
  SELECT event_id, ts, CASE WHEN event_type <> 'click' THEN user_id END AS log_id,
    CASE WHEN event_type = 'click' THEN event_id END AS lone, 'package_' || (user_id % 7) AS package,
    event_type AS task,
    CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN event_type = 'purchase' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS rows_processed,
    CASE WHEN event_type = 'error' THEN 'code ' || CAST(json_extract(props, '$.k') AS INTEGER) END AS error,
    CAST(epoch_us(ts) AS HUGEINT) * 1000000000 + event_id AS ord
  FROM events)
GROUP BY log_id, lone
HAVING lone IS NOT NULL OR log_id IS NULL OR bool_or(status = 'RUNNING')""")

# --- aggregates --------------------------------------------------------------------

_FIRST = ", ".join(
    f"arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderpriority LIKE '%-{p}') AS {p.replace(' ', '_')}"
    for p in ("URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"))
sql("indicator_pivot", (), f"SELECT year(o_orderdate) AS Year, {_FIRST} FROM orders GROUP BY 1")

sql("dedup_keep_first", (), """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn FROM lineitem) WHERE rn = 1""")


def _complete(dataset: str, source: str, column: str, null: str) -> str:
    pct = f"COUNT(*) FILTER (WHERE {null}) * 100.0 / COUNT(*)"
    return (
        f"SELECT '{dataset}' AS dataset, '{column}' AS \"column\", COUNT(*) FILTER (WHERE {null}) AS null_count, "
        f"round({pct}, 2) AS null_pct, {pct} < 5 AS passed FROM {source}"
    )


_LABELLED = "documents LEFT JOIN labels USING (doc_id)"
sql("dq_completeness", (), "\nUNION ALL ".join((
    *(_complete("lineitem", "lineitem", c, f"{c} IS NULL") for c in ("l_orderkey", "l_shipdate", "l_quantity")),
    _complete("orders", "orders", "o_orderkey", "o_orderkey IS NULL"),
    _complete("orders", "orders", "status", "o_orderstatus = 'P'"),
    *(_complete("documents", _LABELLED, c, f"{c} IS NULL") for c in ("text", "quality", "toxic")))))


def _unique(dataset: str, source: str, key: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{key}' AS grain, CAST(SUM(n - 1) AS BIGINT) AS duplicates, "
        f"SUM(n - 1) = 0 AS passed FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {key})"
    )


sql("dq_uniqueness", (), "\nUNION ALL ".join((
    _unique("lineitem", "lineitem", "l_orderkey, l_linenumber"), _unique("orders", "orders", "o_orderkey"),
    _unique("events", "events", "user_id, event_type"), _unique("documents", _LABELLED, "lang, quality"))))


def _stats(dataset: str, source: str, column: str, amount: str) -> str:
    expr = f"CAST(round({amount} * 100) AS BIGINT)"
    middle = (
        f"(SELECT AVG(v) FROM (SELECT CAST({expr} AS DOUBLE) AS v, row_number() OVER (ORDER BY {expr}) AS r, "
        f"COUNT(*) OVER () AS n FROM {source}) WHERE r IN ((n + 1) // 2, n // 2 + 1))"
    )
    return (
        f"SELECT '{dataset}' AS dataset, '{column}' AS \"column\", CAST(MIN({expr}) AS DOUBLE) / 100 AS min, "
        f"CAST(MAX({expr}) AS DOUBLE) / 100 AS max, CAST(SUM({expr}) AS DOUBLE) / COUNT({expr}) / 100 AS mean, "
        f"{middle} / 100 AS median FROM {source}"
    )


sql("summary_stats", (), "\nUNION ALL ".join((
    _stats("lineitem", "lineitem", "quantity", "l_quantity"),
    _stats("lineitem", "lineitem", "price", "l_extendedprice"), _stats("events", "events", "value", "value"))))

_GATE = [
    ("completeness", f"(SELECT COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*) < 5 FROM {t})")
    for t, cols in (
        ("national", ("Year", "CO2_MtCO2e", "Total_GHG_MtCO2e")),
        ("sector_emissions", ("Year", "Sector_Code", "Gas", "Emissions_MtCO2e")),
        ("economy", ("Year", "Province_Code", "GRDP_Billion_VND", "Population")),
        ("provinces", ("Province_Code", "Province_Name", "Region", "Area_Km2")))
    for c in cols
] + [
    ("consistency", "(SELECT COUNT(DISTINCT Year) >= 5 AND COUNT(DISTINCT Year) FILTER (WHERE Year IN (1996, 2000)) = 2 "
     "FROM national WHERE Year IN (SELECT Year FROM sector_emissions) AND Year IN (SELECT Year FROM economy))"),
    ("referential", "(SELECT COUNT(DISTINCT Province_Code) = 25 AND bool_and(Province_Code IN (SELECT Province_Code "
     "FROM provinces)) FROM economy) AND (SELECT COUNT(DISTINCT Province_Code) = 25 FROM provinces)"),
] + [
    ("uniqueness", f"(SELECT COUNT(*) = COUNT(DISTINCT {c}) FROM {t})") for t, c in (
        ("national", "Year"), ("sector_emissions", "(Year, Sector_Code, Gas)"), ("economy", "(Year, Province_Code)"),
        ("provinces", "Province_Code"))
] + [
    ("validity", f"(SELECT COUNT(*) FILTER (WHERE {broken}) = 0 FROM {t})") for t, broken in (
        ("national", "CO2_MtCO2e < 0"), ("national", "Total_GHG_MtCO2e < 0"), ("sector_emissions", "Emissions_MtCO2e < 0"),
        ("economy", "GRDP_Billion_VND <= 0"), ("economy", "Population <= 0"),
        ("economy", "Forest_Coverage_Pct NOT BETWEEN 0 AND 100"), ("economy", "Estimated_Carbon_Tonnes <= 0"))
] + [("row_count", "(SELECT COUNT(*) = 63 FROM provinces)")]
cte("findings", "national", "sector_emissions", "economy", "provinces")(
    "\nUNION ALL ".join(f"SELECT '{check}' AS \"check\", {passed} AS ok" for check, passed in _GATE))
sql("dq_gate", ("findings",), """
SELECT "check", COUNT(*) AS findings, COUNT(*) FILTER (WHERE NOT ok) AS failed, bool_and(ok) AS passed
FROM (SELECT * FROM findings UNION ALL SELECT 'overall', ok FROM findings) GROUP BY "check" """)

sql("sector_rollup", ("national_view",), """
SELECT Scope_Type, Sector_Category, Sector_Name_VI,
  CAST(GROUPING(Scope_Type, Sector_Category, Sector_Name_VI) AS BIGINT) AS level,
  CAST(SUM(Emissions_MtCO2e) AS DOUBLE) AS Emissions
FROM national_view WHERE Sector_Code <> 'TOT' GROUP BY ROLLUP (Scope_Type, Sector_Category, Sector_Name_VI)""")

# --- yearly series -------------------------------------------------------------------

cte("customer_years")(f"""
SELECT o_custkey, year(o_orderdate) AS Year, SUM({money('o_totalprice')}) AS spent FROM orders GROUP BY 1, 2""")

sql("yoy_growth", ("customer_years",), """
SELECT o_custkey, Year, CAST(c AS DOUBLE) AS spent, CAST(p AS DOUBLE) AS spent_minus_1,
  round(CAST(COALESCE(c, 0) - COALESCE(p, 0) AS DOUBLE) / NULLIF(CAST(p AS DOUBLE), 0), 6) AS growth
FROM (SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, COALESCE(a.Year, b.Year + 1) AS Year, a.spent AS c, b.spent AS p
      FROM customer_years a FULL OUTER JOIN customer_years b ON a.o_custkey = b.o_custkey AND a.Year = b.Year + 1)""")

sql("cagr_5y", ("customer_years",), """
SELECT a.o_custkey, a.Year, CAST(a.spent AS DOUBLE) AS spent, CAST(b.spent AS DOUBLE) AS spent_minus_5,
  round(CASE WHEN b.spent > 0 THEN pow(CAST(a.spent AS DOUBLE) / CAST(b.spent AS DOUBLE), 0.2) - 1 END, 6) AS cagr
FROM customer_years a LEFT JOIN customer_years b ON a.o_custkey = b.o_custkey AND a.Year = b.Year + 5""")

# --- nested inputs -------------------------------------------------------------------

sql("json_series_explode", (), """
SELECT o_custkey, year(o_orderdate) AS Year,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CO2' WHEN '2-HIGH' THEN 'GDP' ELSE 'Methane' END AS Indicator,
  CASE WHEN SUM(CAST(o_totalprice AS DECIMAL(18,2))) >= 100000
    THEN CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) END AS Value
FROM orders WHERE year(o_orderdate) <> 2001 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
GROUP BY o_custkey, year(o_orderdate), o_orderpriority""")

sql("sector_series_parse", (), """
SELECT Year, Sector_Code, Sector_Name_EN, Sector_Category, Gas, Source, Emissions_MtCO2e
FROM (
  SELECT *, row_number() OVER (PARTITION BY Year, Sector_Code, Gas ORDER BY Source, Sector_Name_EN) AS rn
  FROM (
    SELECT year(l_shipdate) AS Year,
      CASE p_type WHEN 'ECONOMY' THEN 'ENG' WHEN 'LARGE' THEN 'ELE' WHEN 'MEDIUM' THEN 'IND' WHEN 'PROMO' THEN 'AGR'
        ELSE 'OTH' END AS Sector_Code, p_type AS Sector_Name_EN,
      CASE p_type WHEN 'ECONOMY' THEN 'Energy' WHEN 'LARGE' THEN 'Energy' WHEN 'MEDIUM' THEN 'Industry'
        WHEN 'PROMO' THEN 'Agriculture' ELSE 'Other' END AS Sector_Category,
      CASE l_returnflag WHEN 'N' THEN 'All GHG' ELSE 'CO2' END AS Gas, l_linestatus AS Source,
      CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Emissions_MtCO2e
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('N', 'A')
    GROUP BY year(l_shipdate), p_type, l_returnflag, l_linestatus))
WHERE rn = 1""")

# --- names and maps --------------------------------------------------------------------

sql("name_key_join", (), f"""
SELECT raw_name, {strip_marks('raw_name')} AS match_key, name, Parts
FROM (SELECT 'TP. ' || translate(upper(p_name), 'AEIOUD ', 'ẠẾĨÔŨĐ-') AS raw_name, COUNT(*) AS Parts FROM part GROUP BY 1)
JOIN (SELECT DISTINCT p_name AS name FROM part) ON {strip_marks('raw_name')} = {strip_marks('name')}""")

sql("text_keys", (), f"""
SELECT doc_id, length(key) AS key_chars, md5(key) AS key_md5
FROM (SELECT doc_id, {strip_marks('text')} AS key FROM documents)""")

sql("feature_types", ("provinces",), """
SELECT Province_Code, COUNT(*) AS pieces, COUNT(*) AS rings,
  CASE WHEN COUNT(*) = 1 THEN 'Polygon' ELSE 'MultiPolygon' END AS type
FROM embeddings JOIN provinces ON Province_Name = 'NATION_' || (label * 2) GROUP BY 1""")

sql("nonempty_rows", (), """
SELECT o_custkey, MAX(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
  MAX(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS low
FROM orders GROUP BY 1 HAVING bool_or(o_orderpriority IN ('1-URGENT', '5-LOW'))""")

cte("points")("""
SELECT vec_id, label, i AS pos, CAST(floor(CAST(embedding[2 * i + 1] AS DOUBLE) * 10000) AS BIGINT) AS dx,
  CAST(floor(CAST(embedding[2 * i + 2] AS DOUBLE) * 10000) AS BIGINT) AS dy
FROM (SELECT vec_id, label, embedding, unnest(range(0, len(embedding) // 2)) AS i FROM embeddings)""")
cte("decoded", "points")("""
SELECT *, CAST(SUM(dx) OVER w AS BIGINT) AS running_dx, CAST(SUM(dy) OVER w AS BIGINT) AS running_dy
FROM points WINDOW w AS (PARTITION BY vec_id ORDER BY pos)""")
cte("extent", "decoded")("""
SELECT round(MIN(running_dx * CAST(0.0001 AS DOUBLE) + 102), 6) AS min_lon,
  round(MIN(running_dy * CAST(0.0002 AS DOUBLE) + 8), 6) AS min_lat,
  round(MAX(running_dx * CAST(0.0001 AS DOUBLE) + 102), 6) AS max_lon,
  round(MAX(running_dy * CAST(0.0002 AS DOUBLE) + 8), 6) AS max_lat FROM decoded""")
sql("delta_decode_bbox", ("decoded",), """
SELECT vec_id, MIN(running_dx) AS min_x, MIN(running_dy) AS min_y, MAX(running_dx) AS max_x, MAX(running_dy) AS max_y
FROM decoded GROUP BY vec_id""")
sql("map_bounding_box", ("extent",), "SELECT * FROM extent")
sql("delta_running_points", ("decoded",), "SELECT vec_id, pos, dx, dy, running_dx, running_dy FROM decoded")
sql("map_gate", ("extent", "provinces"), """
SELECT 'geometries' AS "check", COUNT(*) AS value, COUNT(*) = 63 AS passed FROM embeddings
UNION ALL SELECT 'invalid_codes', COUNT(*), COUNT(*) = 0 FROM embeddings WHERE label + 5 = 0
UNION ALL SELECT 'empty_geometries', COUNT(*), COUNT(*) = 0 FROM embeddings WHERE len(embedding) = 0
UNION ALL SELECT 'missing_codes', COUNT(*), COUNT(*) = 0 FROM provinces
  WHERE Province_Code NOT IN (SELECT lpad(CAST(label + 5 AS VARCHAR), 2, '0') FROM embeddings)
UNION ALL SELECT 'extra_codes', COUNT(DISTINCT label), COUNT(DISTINCT label) = 0 FROM embeddings
  WHERE lpad(CAST(label + 5 AS VARCHAR), 2, '0') NOT IN (SELECT Province_Code FROM provinces)
UNION ALL SELECT 'missing_names', COUNT(*), COUNT(*) = 0 FROM provinces
  WHERE Province_Name NOT IN (SELECT 'NATION_' || (label + 5) FROM embeddings)
UNION ALL SELECT 'bounding_box', CAST(ok AS BIGINT), ok FROM (
  SELECT min_lon BETWEEN 100 AND 104 AND min_lat BETWEEN 8 AND 10 AND max_lon BETWEEN 108 AND 120
    AND max_lat BETWEEN 22 AND 25 AS ok FROM extent)""")

# --- air, allocation and population -----------------------------------------------------

sql("aqi_index", ("readings",), "SELECT event_id, AQI_Index, Is_Exceeding_QCVN FROM readings")
sql("aqi_category_hours", ("readings",), """
SELECT Station_Code, AQI_Category, COUNT(*) AS Hours, COUNT(*) FILTER (WHERE Is_Exceeding_QCVN) AS Exceeding
FROM readings GROUP BY 1, 2""")

sql("allocate_by_share", (), f"""
SELECT Year, Province_Code, GRDP_Billion_VND, Carbon_Mt, round(Carbon_Mt * 1000000, 0) AS Estimated_Carbon_Tonnes,
  round(round(Carbon_Mt * 1000000, 0) / NULLIF(GRDP_Billion_VND, 0), 2) AS Decoupling_Index
FROM (
  SELECT t.y AS Year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS Province_Code,
    round(COALESCE(grdp, 10000000) * share, 2) AS GRDP_Billion_VND,
    round(COALESCE(ghg, 500) * (share * CAST(CASE WHEN c_nationkey % 2 = 0 THEN 1.6 ELSE 0.75 END AS DOUBLE)), 3) AS Carbon_Mt
  FROM (SELECT c_nationkey, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM customer) AS share FROM customer GROUP BY 1)
  CROSS JOIN range((SELECT MIN(year(o_orderdate)) FROM orders), (SELECT MAX(year(o_orderdate)) + 2 FROM orders)) t(y)
  LEFT JOIN (SELECT year(o_orderdate) AS y, CAST(SUM({money('o_totalprice')}) AS DOUBLE) AS grdp,
               CAST(COUNT(*) AS DOUBLE) / 1000 AS ghg FROM orders GROUP BY 1) n ON n.y = t.y)""")

sql("population_projection", ("provinces",), """
SELECT t.y AS Year, p.Province_Code,
  CAST(floor(COALESCE(base, floor(CAST(Area_Km2 AS DOUBLE) * 0.25 + 800)) * 1000
    * (1.0 + (t.y - 2015) * CAST(0.011 AS DOUBLE))) AS BIGINT) AS Population
FROM provinces p CROSS JOIN range(2015, 2025) t(y)
LEFT JOIN (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS c, COUNT(*) * 1000 AS base
           FROM supplier WHERE s_acctbal < 0 GROUP BY 1) ON c = p.Province_Code""")

# --- measures ------------------------------------------------------------------------------


def national_sums(by: str = "") -> str:
    return f"""
SELECT Year{by}, CAST(SUM(Emissions_MtCO2e) AS DOUBLE) AS ghg, CAST(SUM(CO2_MtCO2e) AS DOUBLE) AS co2,
  CAST(SUM(Methane_MtCO2e) AS DOUBLE) AS ch4,
  CAST(MAX(CASE WHEN Sector_Code = 'TOT' THEN GDP_USD END) AS DOUBLE) AS gdp, {mean('Renewable_Energy_Pct')} AS ren
FROM national_view GROUP BY Year{by}"""


_CUT = "(1 - CAST(0.435 AS DOUBLE))"
_INTENSITY = "ghg * 1000000 / NULLIF(gdp / 1000000, 0)"
cte("national_sums", "national_view")(national_sums())
cte("national_years", "national_sums", "dates")(f"""
SELECT d.Year, s.ghg, s.co2, s.ch4, s.gdp, s.ren, p.ghg AS prior, b.ghg AS base, z.ghg AS baseline,
  z.ghg * {_CUT} AS target,
  CASE WHEN s.ghg IS NOT NULL OR z.ghg IS NOT NULL THEN COALESCE(s.ghg, 0) - COALESCE(z.ghg * {_CUT}, 0) END AS gap
FROM dates d LEFT JOIN national_sums s ON s.Year = d.Year LEFT JOIN national_sums p ON p.Year = d.Year - 1
LEFT JOIN national_sums b ON b.Year = d.Year - 5 LEFT JOIN national_sums z ON z.Year = 1996""")
_YOY = "CASE WHEN ghg IS NOT NULL OR prior IS NOT NULL THEN (COALESCE(ghg, 0) - COALESCE(prior, 0)) / NULLIF(prior, 0) END"
_CAGR = "round(CASE WHEN base > 0 THEN pow(ghg / base, 0.2) - 1 END, 6)"
sql("measures_national_by_year", ("national_years",), f"""
SELECT Year, ghg AS Total_GHG_Emissions, co2 AS Total_CO2_Emissions, ch4 AS Total_Methane_Emissions, gdp AS National_GDP,
  {_INTENSITY} AS National_Emission_Intensity, ren AS Renewable_Energy_Pct, prior AS Emissions_Prior_Year,
  baseline AS Baseline_Emissions, {_YOY} AS Emissions_YoY_Growth, {_CAGR} AS Emissions_CAGR_5Y,
  target AS Target_Emission, gap AS Target_Gap,
  CASE WHEN gap IS NULL THEN {quoted(k.GAP_NONE)}
    WHEN gap <= 0 THEN {quoted(k.GAP_WITHIN[0])} || format('{{:,.1f}}', round(abs(gap), 1)) || {quoted(k.GAP_WITHIN[1])}
    ELSE {quoted(k.GAP_OVER[0])} || format('{{:,.1f}}', round(gap, 1)) || {quoted(k.GAP_OVER[1])} END AS KPI_Subtitle
FROM national_years""")

cte("sector_sums", "national_view")(national_sums(", Sector_Code"))
sql("measures_national_by_sector", ("sector_sums", "dates"), f"""
SELECT Year, Sector_Code, ghg AS Total_GHG_Emissions, gdp AS National_GDP, {_INTENSITY} AS National_Emission_Intensity, prior AS Emissions_Prior_Year, {_YOY} AS Emissions_YoY_Growth,
  {_CAGR} AS Emissions_CAGR_5Y, CASE WHEN ghg IS NOT NULL OR z IS NOT NULL
    THEN COALESCE(ghg, 0) - COALESCE(z * {_CUT}, 0) END AS Target_Gap
FROM (
  SELECT d.Year, k.Sector_Code, s.ghg, p.ghg AS prior, b.ghg AS base, z.ghg AS z,
    (SELECT MAX(t.gdp) FROM sector_sums t WHERE t.Year = d.Year AND t.Sector_Code = 'TOT') AS gdp
  FROM dates d CROSS JOIN (SELECT DISTINCT Sector_Code FROM sector_sums) k
  LEFT JOIN sector_sums s ON s.Year = d.Year AND s.Sector_Code = k.Sector_Code
  LEFT JOIN sector_sums p ON p.Year = d.Year - 1 AND p.Sector_Code = k.Sector_Code
  LEFT JOIN sector_sums b ON b.Year = d.Year - 5 AND b.Sector_Code = k.Sector_Code
  LEFT JOIN sector_sums z ON z.Year = 1996 AND z.Sector_Code = k.Sector_Code)""")

sql("measures_guarded", ("national_view",), """
SELECT Year, CAST(SUM(Emissions_MtCO2e) AS DOUBLE) AS Total_GHG_Emissions_guarded,
  CAST(SUM(CO2_MtCO2e) AS DOUBLE) AS Total_CO2_Emissions_guarded,
  CAST(SUM(Methane_MtCO2e) AS DOUBLE) AS Total_Methane_Emissions_guarded
FROM national_view WHERE Sector_Code = 'TOT' AND Gas = 'N' GROUP BY Year""")

cte("target", "national_sums")(f"SELECT ghg * {_CUT} AS tons FROM national_sums WHERE Year = 1996")


def provincial_years(by: str) -> str:
    return f"""
SELECT d.Year, a.{by}, s.c, s.g, s.pop, s.idx, s.forest, a.area, t.g AS total, p.g AS prior,
  (SELECT tons FROM target) * 1000000 * CASE WHEN COALESCE(t.g, 0) = 0 THEN 0 ELSE s.g / t.g END AS quota
FROM dates d CROSS JOIN (SELECT {by}, CAST(SUM(Area_Km2) AS DOUBLE) AS area FROM provinces GROUP BY 1) a
LEFT JOIN sums_{by} s ON s.Year = d.Year AND s.{by} = a.{by}
LEFT JOIN sums_{by} p ON p.Year = d.Year - 1 AND p.{by} = a.{by}
LEFT JOIN (SELECT Year, CAST(SUM(GRDP_Billion_VND) AS DOUBLE) AS g FROM provincial_view GROUP BY 1) t ON t.Year = d.Year"""


for _by in ("Province_Code", "Region"):
    cte(f"sums_{_by}", "provincial_view")(f"""
SELECT Year, {_by}, CAST(SUM(Estimated_Carbon_Tonnes) AS DOUBLE) AS c, CAST(SUM(GRDP_Billion_VND) AS DOUBLE) AS g,
  CAST(SUM(Population) AS DOUBLE) AS pop, {mean('Decoupling_Index')} AS idx, {mean('Forest_Coverage_Pct')} AS forest
FROM provincial_view GROUP BY 1, 2""")
    cte(f"years_{_by}", f"sums_{_by}", "dates", "target")(provincial_years(_by))

_GROWTH = "CASE WHEN g IS NOT NULL OR prior IS NOT NULL THEN (COALESCE(g, 0) - COALESCE(prior, 0)) / NULLIF(prior, 0) END"
sql("measures_provincial", ("years_Province_Code",), f"""
SELECT Year, Province_Code, c AS Provincial_Carbon_Tonnes, g AS Provincial_GRDP, pop AS Provincial_Population,
  idx AS Provincial_Decoupling_Index, c / NULLIF(g, 0) AS Carbon_Intensity, c / NULLIF(pop, 0) AS Carbon_Per_Capita,
  forest AS Forest_Coverage_Pct, prior AS GRDP_Prior_Year, c / NULLIF(area, 0) AS Carbon_Density,
  {_GROWTH} AS GRDP_YoY_Growth, quota AS Provincial_Emission_Quota, quota AS Provincial_Quota_Carbon_Tonnes,
  c / NULLIF(quota, 0) AS Quota_Realization, {color('idx')} AS Decoupling_Color_Hex, {status('idx')} AS Decoupling_Status_Label
FROM years_Province_Code""")
sql("measures_provincial_by_region", ("years_Region",), f"""
SELECT Year, Region, g AS Provincial_GRDP, c / NULLIF(area, 0) AS Carbon_Density, {_GROWTH} AS GRDP_YoY_Growth,
  c / NULLIF(quota, 0) AS Quota_Realization FROM years_Region""")

_AIR = f"""
{mean('AQI_Index')} AS Avg_AQI_Index, {mean('PM25_ug_m3')} AS Avg_PM25, {mean('CO2_ppm')} AS Avg_CO2_Concentration,
CAST(SUM(CAST(Is_Exceeding_QCVN AS INTEGER)) AS BIGINT) AS Exceeding_QCVN_Hours,
CAST(SUM(CAST(Is_Exceeding_QCVN AS INTEGER)) AS DOUBLE) / COUNT(*) AS Exceeding_QCVN_Rate,
CAST(SUM(CASE WHEN Is_Rush_Hour THEN CAST(Is_Exceeding_QCVN AS INTEGER) END) AS BIGINT) AS Rush_Hour_Exceeding_Hours,
{aqi_color(mean('AQI_Index'))} AS AQI_Status_Color_Hex"""
sql("measures_air", ("hourly_view",), f"SELECT Province_Code, Station_Type, {_AIR} FROM hourly_view GROUP BY 1, 2")
sql("measures_air_total", ("hourly_view",), f"SELECT Region, Time_Bucket, {_AIR} FROM hourly_view GROUP BY 1, 2")

sql("provincial_narrative", ("provincial_view", "hourly_view", "target"), f"""
SELECT Province_Code, Province_Name, {quoted(k.CARD_TITLE)} || Province_Name AS Card_Title,
  {quoted(k.NARRATIVE_TITLE)} || upper(Province_Name) || chr(10) ||
  {quoted(k.NARRATIVE_ECONOMY[0])} || COALESCE(format('{{:,.1f}}', round(g, 1)), '') || {quoted(k.NARRATIVE_ECONOMY[1])}
  || COALESCE(format('{{:,.2f}}', round(c / 1000000, 2)), '') || {quoted(k.NARRATIVE_ECONOMY[2])} || chr(10) ||
  {quoted(k.NARRATIVE_INDEX[0])} || COALESCE(printf('%.2f', round(idx, 2)), '') || {quoted(k.NARRATIVE_INDEX[1])}
  || {status('idx')} || {quoted(k.NARRATIVE_INDEX[2])} || chr(10) ||
  {quoted(k.NARRATIVE_QUOTA[0])} || COALESCE(printf('%.1f', round(c / NULLIF(tons * 1000000 * (g / total), 0) * 100, 1)) || '%', '')
  || {quoted(k.NARRATIVE_QUOTA[1])} || chr(10) ||
  {quoted(k.NARRATIVE_AIR[0])} || COALESCE(format('{{:,}}', hours), '') || {quoted(k.NARRATIVE_AIR[1])} || chr(10) ||
  {" || ".join("chr(10) || " + quoted(line) for line in k.NARRATIVE_ADVICE)} AS Narrative
FROM (
  SELECT p.Province_Code, p.Province_Name, g, c, idx, hours, tons, (SELECT CAST(SUM(GRDP_Billion_VND) AS DOUBLE) FROM provincial_view) AS total
  FROM provinces p
  LEFT JOIN (SELECT Province_Code, CAST(SUM(GRDP_Billion_VND) AS DOUBLE) AS g, CAST(SUM(Estimated_Carbon_Tonnes) AS DOUBLE) AS c,
               {mean('Decoupling_Index')} AS idx FROM provincial_view GROUP BY 1) e ON e.Province_Code = p.Province_Code
  LEFT JOIN (SELECT Province_Code, CAST(SUM(CAST(Is_Exceeding_QCVN AS INTEGER)) AS BIGINT) AS hours
             FROM hourly_view GROUP BY 1) a ON a.Province_Code = p.Province_Code
  CROSS JOIN target)""")

sql("card_title", ("provinces",), f"""
SELECT Economic_Zone, Region, {quoted(k.CARD_TITLE)} || CASE WHEN COUNT(DISTINCT Province_Name) = 1 THEN MIN(Province_Name)
  ELSE {quoted(k.NO_SELECTION)} END AS Card_Title FROM provinces GROUP BY 1, 2""")

sql("measures_air_by_rush", ("hourly_view",), f"""
SELECT r.* EXCLUDE (Rush_Hour_Exceeding_Hours), w.h AS Rush_Hour_Exceeding_Hours
FROM (SELECT Region, Is_Rush_Hour, {_AIR} FROM hourly_view GROUP BY 1, 2) r
JOIN (SELECT Region, CAST(SUM(CASE WHEN Is_Rush_Hour THEN CAST(Is_Exceeding_QCVN AS INTEGER) END) AS BIGINT) AS h
      FROM hourly_view GROUP BY 1) w ON w.Region = r.Region""")

_WHOLE = """CAST(SUM(Emissions_MtCO2e) AS DOUBLE) AS ghg, CAST(SUM(CO2_MtCO2e) AS DOUBLE) AS co2"""
_GDP = "CAST(MAX(CASE WHEN Sector_Code = 'TOT' THEN GDP_USD END) AS DOUBLE) AS gdp"
sql("measures_by_decade", ("national_view",), f"""
SELECT s.Decade, s.Sector_Code, ghg AS Total_GHG_Emissions, co2 AS Total_CO2_Emissions, gdp AS National_GDP,
  {_INTENSITY} AS National_Emission_Intensity
FROM (SELECT Year // 10 * 10 || 's' AS Decade, Sector_Code, {_WHOLE} FROM national_view GROUP BY 1, 2) s
JOIN (SELECT Year // 10 * 10 || 's' AS Decade, {_GDP} FROM national_view GROUP BY 1) g ON g.Decade = s.Decade""")
sql("measures_total", ("national_view",), f"""
SELECT ghg AS Total_GHG_Emissions, co2 AS Total_CO2_Emissions, gdp AS National_GDP,
  {_INTENSITY} AS National_Emission_Intensity FROM (SELECT {_WHOLE}, {_GDP} FROM national_view)"""
)
sql("dashboard_gdp_co2", ("national_sums",), f"""
SELECT Year, gdp AS National_GDP, co2 AS Total_CO2_Emissions, {_INTENSITY} AS National_Emission_Intensity FROM national_sums""")
sql("dashboard_sector_share", ("national_view",), """
SELECT Year, Sector_Code, CAST(SUM(Emissions_MtCO2e) AS DOUBLE) AS Total_GHG_Emissions,
  CAST(SUM(Emissions_MtCO2e) AS DOUBLE) / NULLIF(CAST(SUM(SUM(Emissions_MtCO2e)) OVER (PARTITION BY Year) AS DOUBLE), 0) AS Share
FROM national_view WHERE Sector_Code <> 'TOT' GROUP BY 1, 2""")

sql("tapio_elasticity", ("provincial_view",), """
SELECT a.Province_Code, a.Year, CAST(a.c - b.c AS DOUBLE) / NULLIF(CAST(b.c AS DOUBLE), 0) AS Carbon_Growth,
  CAST(a.g - b.g AS DOUBLE) / NULLIF(CAST(b.g AS DOUBLE), 0) AS GRDP_Growth,
  (CAST(a.c - b.c AS DOUBLE) / NULLIF(CAST(b.c AS DOUBLE), 0)) / NULLIF(CAST(a.g - b.g AS DOUBLE) / NULLIF(CAST(b.g AS DOUBLE), 0), 0) AS Elasticity
FROM (SELECT Province_Code, Year, SUM(Estimated_Carbon_Tonnes) AS c, SUM(GRDP_Billion_VND) AS g FROM provincial_view GROUP BY 1, 2) a
JOIN (SELECT Province_Code, Year, SUM(Estimated_Carbon_Tonnes) AS c, SUM(GRDP_Billion_VND) AS g FROM provincial_view GROUP BY 1, 2) b
  ON a.Province_Code = b.Province_Code AND a.Year = b.Year + 1""")

sql("pm25_daily_limit", ("readings",), f"""
SELECT Station_Code, Date_Key AS Year, Month, Day, {mean('PM25_ug_m3')} AS Mean_PM25, {mean('PM25_ug_m3')} > 50 AS Is_Exceeding
FROM readings GROUP BY 1, 2, 3, 4""")

# --- written tables ---------------------------------------------------------------------

ORACLES["hourly_stream_upsert"] = ORACLES["hourly_fact"]
ORACLES["bucketed_merge"] = ORACLES["scd1_merge"]

sql("snapshot_reload", (), """
SELECT CAST(1 AS BIGINT) AS Version, year(o_orderdate) AS Date_Key, 'loaded' AS origin, COUNT(*) AS Fact_Rows FROM orders GROUP BY 2
UNION ALL
SELECT 2, Date_Key, origin, COUNT(*)
FROM (SELECT year(o_orderdate) AS Date_Key, 'loaded' AS origin FROM orders
      WHERE year(o_orderdate) NOT IN (SELECT year(l_shipdate) FROM lineitem WHERE year(l_shipdate) >= 1996)
      UNION ALL SELECT year(l_shipdate), 'staged' FROM lineitem
      WHERE year(l_shipdate) >= 1996 AND year(l_shipdate) % 2 = 0)
GROUP BY 2, 3""")

sql("clustered_station_days", ("hourly_fact",), """
SELECT Station_Key, Day, COUNT(*) AS Readings, CAST(SUM(PM25_ug_m3) AS DOUBLE) AS PM25
FROM hourly_fact WHERE Station_Key IN (3, 7, 11) AND Month = 1 AND Day BETWEEN 5 AND 9 GROUP BY 1, 2""")

sql("incremental_profile", (), """
WITH lines AS (SELECT * FROM lineitem WHERE year(l_shipdate) <> 1996 OR l_returnflag <> 'R')
SELECT 'l_orderkey' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT(l_orderkey) AS nulls, CAST(NULL AS DOUBLE) AS min,
  CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, CAST(1 AS BIGINT) AS slices_profiled_again FROM lines
UNION ALL SELECT 'l_returnflag', COUNT(*), COUNT(*) - COUNT(l_returnflag), NULL, NULL, NULL, 1 FROM lines
UNION ALL SELECT 'l_quantity', COUNT(*), COUNT(*) - COUNT(l_quantity), MIN(l_quantity), MAX(l_quantity),
  round(CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_quantity), 6), 1 FROM lines
UNION ALL SELECT 'l_extendedprice', COUNT(*), COUNT(*) - COUNT(l_extendedprice), MIN(l_extendedprice), MAX(l_extendedprice),
  round(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_extendedprice), 6), 1 FROM lines""")

sql("measures_air_grains", ("hourly_view",), f"""
SELECT 'Province_Code+Station_Type' AS grain, Province_Code, Station_Type, CAST(NULL AS VARCHAR) AS Region,
  CAST(NULL AS VARCHAR) AS Time_Bucket, CAST(NULL AS BOOLEAN) AS Is_Rush_Hour, {_AIR} FROM hourly_view GROUP BY 2, 3
UNION ALL BY NAME
SELECT 'Region+Time_Bucket' AS grain, Region, Time_Bucket, {_AIR} FROM hourly_view GROUP BY 2, 3
UNION ALL BY NAME
SELECT 'Is_Rush_Hour+Region' AS grain, r.* EXCLUDE (Rush_Hour_Exceeding_Hours), w.h AS Rush_Hour_Exceeding_Hours
FROM (SELECT Region, Is_Rush_Hour, {_AIR} FROM hourly_view GROUP BY 1, 2) r
JOIN (SELECT Region, CAST(SUM(CASE WHEN Is_Rush_Hour THEN CAST(Is_Exceeding_QCVN AS INTEGER) END) AS BIGINT) AS h
      FROM hourly_view GROUP BY 1) w ON w.Region = r.Region""")

ORACLES["plan_phase_by_bands"] = ORACLES["plan_phase_band"]

sql("stitched_features", ("decoded", "provinces"), """
, ends AS (SELECT vec_id, MAX(pos) AS last, arg_min(running_dx, pos) AS ax, arg_min(running_dy, pos) AS ay FROM decoded GROUP BY vec_id HAVING MAX(pos) > 0),
walk AS (
  SELECT d.vec_id, d.pos AS place, d.running_dx AS x, d.running_dy AS y FROM decoded d JOIN ends e ON e.vec_id = d.vec_id
  UNION ALL SELECT vec_id, last + 1, ax + 7, ay - 3 FROM ends
  UNION ALL SELECT vec_id, last + 2, ax, ay FROM ends
), places AS (
  SELECT p.Province_Code, p.Province_Name, p.Region, e.vec_id
  FROM embeddings e JOIN provinces p ON p.Province_Name = 'NATION_' || (e.label * 2) JOIN ends ON ends.vec_id = e.vec_id
)
SELECT Province_Code, Province_Name, Region, COUNT(DISTINCT p.vec_id) AS pieces, COUNT(DISTINCT p.vec_id) AS polygons,
  COUNT(DISTINCT p.vec_id) AS rings, COUNT(DISTINCT p.vec_id) AS closed_rings, COUNT(*) AS points,
  CASE WHEN COUNT(DISTINCT p.vec_id) = 1 THEN 'Polygon' ELSE 'MultiPolygon' END AS type,
  CAST(SUM(place * x) AS BIGINT) AS walk_x, CAST(SUM(place * y) AS BIGINT) AS walk_y
FROM places p JOIN walk ON walk.vec_id = p.vec_id GROUP BY 1, 2, 3""")
ORACLES["stitched_features"] = ORACLES["stitched_features"].replace(")\n, ends AS", "),\nends AS", 1)

sql("landed_payload_fields", (), """
SELECT year(o_orderdate) AS Year, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS Priority, COUNT(*) AS Records,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS Total FROM orders GROUP BY 1, 2""")

sql("csv_round_trip", (), """
SELECT 'C' || c_nationkey AS Nation_Code, c_custkey AS Row, '"' || c_name || '", ' || c_custkey AS Name,
  CASE WHEN c_acctbal >= 0 THEN CAST(round_even(c_acctbal * 100, 0) AS BIGINT) ELSE 0 END AS Cents FROM customer""")

sql("payload_round_trip", (), """
SELECT year(o_orderdate) AS Year, COUNT(*) AS Points, COUNT(DISTINCT o_custkey) AS Customers, CAST(SUM(o_orderkey) AS BIGINT) AS Total
FROM orders GROUP BY 1""")

sql("staged_reload", (), """
SELECT 'third.csv' AS Source_File, COUNT(*) FILTER (WHERE o_orderkey % 3 = 0) AS Staged,
  COUNT(*) FILTER (WHERE o_orderkey % 2 = 0) AS Second, CAST(0 AS BIGINT) AS Truncated FROM orders""")

sql("enriched_features", ("provinces",), """
SELECT Province_Code, CASE WHEN COUNT(*) = 1 THEN 'Polygon' ELSE 'MultiPolygon' END AS type,
  md5(string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY vec_id)) AS rings_md5, Province_Code AS id, Province_Name, Region, Economic_Zone
FROM embeddings e JOIN provinces ON Province_Name = 'NATION_' || (e.label * 2)
GROUP BY Province_Code, Province_Name, Region, Economic_Zone""")

sql("catalog_columns", ("provinces",), """
SELECT Province_Code, Province_Name, Province_Name_Ascii, Region, Economic_Zone, CAST(Area_Km2 AS DOUBLE) AS Area_Km2, Is_Industrial_Hub FROM provinces""")

_STAGED_SECTORS = {"1-URGENT": "ENG", "2-HIGH": "TRA", "3-MEDIUM": "IPU", "4-NOT SPECIFIED": "WST", "5-LOW": "ZZZ"}
_SCOPES = {code: scope for code, *_, scope in k.SECTOR_SEED}
sql("seeded_sectors", (), """
SELECT Sector_Code, MIN(p) AS Sector_Name_EN, CAST(COUNT(*) AS VARCHAR) AS Sector_Name_VI, 'Staged' AS Sector_Category, MIN(Scope_Type) AS Scope_Type
FROM (SELECT o_orderpriority AS p, Sector_Code, Scope_Type FROM orders JOIN (VALUES """ + ", ".join(
    f"('{p}', '{code}', {quoted(_SCOPES[code]) if code in _SCOPES else 'CAST(NULL AS VARCHAR)'})" for p, code in _STAGED_SECTORS.items()
) + """) m(p, Sector_Code, Scope_Type) ON m.p = o_orderpriority)
GROUP BY Sector_Code""")
