"""Measures with gaps, blanks and missing sides; views and analytic queries on small facts."""

import pytest
from pyspark.sql import functions as F

from carbonloom import constants as k
from carbonloom.operators.generators import dim_date
from carbonloom.plans import kpis, measures, variants
from helpers import as_dicts, by_key

NATIONAL = ("Year int, Decade string, Five_Year_Plan_Phase string, Sector_Code string, Sector_Category string, "
            "Sector_Name_VI string, Gas string, Emissions_MtCO2e double, CO2_MtCO2e double, Methane_MtCO2e double, "
            "Renewable_Energy_Pct double, GDP_USD double")


@pytest.fixture
def national(rows):
    def row(year, code, gas, value, gdp=None, renewable=None):
        return (year, f"{year // 10 * 10}s", "P", code, code, code, gas, value, 10.0, 1.0, renewable, gdp)

    return rows(
        NATIONAL,
        row(2015, "TOT", "All GHG", 100.0, 2e9, 20.0), row(2015, "ENG", "All GHG", 60.0),
        row(2015, "ENG", "CO2", 40.0), row(2020, "TOT", "All GHG", 200.0, 4e9, 30.0),
        row(2020, "TOT", "CO2", 100.0, 4e9, 30.0), row(2021, "ENG", "All GHG", 30.0),
        row(2021, "AGR", "All GHG", 10.0),
    )


def test_national_years(spark, national):
    found = by_key(measures.national_by_year(national, dim_date(spark)), "Year")
    assert len(found) == 81
    y = found[2015]
    assert y["Total_GHG_Emissions"] == 200.0 and y["Total_CO2_Emissions"] == 30.0
    assert y["National_GDP"] == 2e9 and y["Renewable_Energy_Pct"] == 20.0
    assert y["National_Emission_Intensity"] == 200.0 * 1e6 / 2e3
    assert found[2016]["Emissions_Prior_Year"] == 200.0 and found[2016]["Emissions_YoY_Growth"] == -1.0
    assert found[2017]["Emissions_YoY_Growth"] is None
    assert found[2020]["Emissions_CAGR_5Y"] == pytest.approx((300 / 200) ** 0.2 - 1)
    assert found[2021]["Emissions_CAGR_5Y"] is None
    assert found[2021]["Emissions_YoY_Growth"] == pytest.approx((40 - 300) / 300)
    assert all(r["Baseline_Emissions"] == 300.0 for r in found.values())
    target = 300.0 * (1 - 0.435)
    assert found[2050]["Target_Emission"] == target and found[2050]["Target_Gap"] == -target
    assert found[2020]["KPI_Subtitle"] == "Exceeding NDC 2030 Emission Quota (+ 130.5 MtCO2e)"
    assert found[2050]["KPI_Subtitle"] == "Within NDC 2030 Target Safety Limit (Surplus: 169.5 MtCO2e)"


def test_no_baseline_gives_no_comparison(spark, national):
    found = by_key(measures.national_by_year(national, dim_date(spark), baseline_year=1999), "Year")
    assert found[1970]["KPI_Subtitle"] == k.GAP_NONE
    assert found[2015]["Target_Gap"] == 200.0


def test_national_by_sector_and_guarded(spark, national):
    found = {(r.Year, r.Sector_Code): r for r in measures.national_by_year(national, dim_date(spark), ["Sector_Code"]).collect()}
    assert len(found) == 81 * 3
    assert found[(2021, "ENG")].Baseline_Emissions is None and found[(2021, "TOT")].Baseline_Emissions == 300.0
    guarded = by_key(measures.guarded(national, ["Year"]), "Year")
    assert guarded[2015]["Total_GHG_Emissions_guarded"] == 100.0 and guarded[2020]["Total_GHG_Emissions_guarded"] == 200.0


def test_any_measure_at_any_grain(national):
    found = by_key(measures.measure(national, ["Total_GHG_Emissions"], ["Sector_Code"], F.col("Gas") == "All GHG"), "Sector_Code")
    assert found["ENG"]["Total_GHG_Emissions"] == 90.0
    assert len(measures.BASE) == 6 + 9 + 7


def test_decade_and_phase_queries(national):
    decades = by_key(kpis.decade_trend(national), "Decade")
    assert decades["2010s"]["Years_Count"] == 1 and decades["2010s"]["Avg_Renewable_Pct"] == 20.0
    # two gas rows of the total double the CO2 of the decade; the sum is divided by the mean GDP
    assert decades["2020s"]["Total_CO2_MtCO2e"] == 20.0
    assert decades["2020s"]["Carbon_Intensity_Tonnes_Per_1k_USD"] == 20.0 * 1e6 / (4e9 / 1e3)
    no_gdp = by_key(kpis.decade_trend(national.withColumn("GDP_USD", F.lit(None).cast("double"))), "Decade")
    assert no_gdp["2020s"]["Carbon_Intensity_Tonnes_Per_1k_USD"] == 0.0 and no_gdp["2020s"]["Avg_GDP_Billion_USD"] is None
    shares = by_key(kpis.sector_share_by_phase(national), "Sector_Name_VI")
    assert set(shares) == {"ENG", "AGR"}
    assert shares["ENG"]["Period_Total_Emissions_MtCO2e"] == 90.0 and shares["ENG"]["Annual_Avg_Emissions_MtCO2e"] == 45.0
    assert shares["ENG"]["Sector_Contribution_Pct"] == 90.0


PROVINCIAL = ("Year int, Province_Code string, Province_Name string, Region string, Economic_Zone string, "
              "Is_Industrial_Hub boolean, GRDP_Billion_VND double, Population long, Estimated_Carbon_Tonnes double, "
              "Decoupling_Index double, Forest_Coverage_Pct double")


@pytest.fixture
def provincial(rows):
    def row(year, code, grdp, carbon, index):
        return (year, code, f"P{code}", "R", "Z", True, grdp, 100, carbon, index, 10.0)

    return rows(
        PROVINCIAL,
        row(2023, "01", 100.0, 50.0, 1.0), row(2024, "01", 300.0, 60.0, 101.0), row(2024, "02", 100.0, 90.0, 75.0),
        row(2024, "03", 0.0, 0.0, -1.0),
    )


@pytest.fixture
def places(rows):
    return rows("Province_Code string, Province_Name string, Region string, Area_Km2 double",
                ("01", "P01", "R", 10.0), ("02", "P02", "R", 0.0), ("03", "P03", "S", 5.0), ("04", "P04", "S", 5.0))


def test_provincial_years(spark, provincial, places):
    rows_ = measures.provincial_by_year(provincial, places, dim_date(spark), F.lit(2.0))
    found = {(r.Year, r.Province_Code): r for r in rows_.collect()}
    assert len(found) == 81 * 4
    a = found[(2024, "01")]
    assert a.GRDP_Prior_Year == 100.0 and a.GRDP_YoY_Growth == 2.0
    assert a.Provincial_Emission_Quota == 2.0 * 1e6 * 0.75 == a.Provincial_Quota_Carbon_Tonnes
    assert a.Quota_Realization == 60.0 / 1.5e6 and a.Carbon_Intensity == 0.2 and a.Carbon_Density == 6.0
    assert a.Decoupling_Status_Label == "Negative Decoupling (Carbon Intensive)" and a.Decoupling_Color_Hex == "#EF4444"
    assert found[(2024, "02")].Carbon_Density is None
    assert found[(2024, "03")].Carbon_Intensity is None and found[(2024, "03")].Decoupling_Status_Label == "Strong Decoupling"
    assert found[(2025, "01")].GRDP_YoY_Growth == -1.0 and found[(2025, "01")].Provincial_Emission_Quota == 0.0
    # a year without any GRDP has share 0, a province without GRDP in a year with some has none
    assert found[(1990, "01")].Provincial_Emission_Quota == 0.0
    assert found[(2024, "04")].Provincial_Emission_Quota is None
    assert found[(2024, "04")].Decoupling_Status_Label == "No Data"


def test_area_is_counted_once_per_province(spark, provincial, places):
    rows_ = measures.provincial_by_year(provincial, places, dim_date(spark), F.lit(2.0), ["Region"])
    found = {(r.Year, r.Region): r for r in rows_.collect()}
    assert found[(2024, "R")].Carbon_Density == 150.0 / 10.0


def test_top_and_quadrants(provincial):
    top = as_dicts(kpis.top_emitters_latest_year(provincial))
    assert [(t["Province_Code"], t["Emission_Rank"]) for t in top] == [("02", 1), ("01", 2), ("03", 3)]
    assert [t["Decoupling_Status"] for t in top] == [k.GREEN_LABELS[1], k.GREEN_LABELS[0], k.GREEN_LABELS[2]]
    quadrants = by_key(kpis.quadrant_matrix(provincial), "Province_Code")
    assert quadrants["01"]["Quadrant_Classification"] == k.QUADRANTS[1]
    assert quadrants["02"]["Quadrant_Classification"] == k.QUADRANTS[2]
    assert quadrants["03"]["Quadrant_Classification"] == k.QUADRANTS[3]


@pytest.fixture
def hourly(rows):
    return rows(
        "Province_Code string, AQI_Index int, PM25_ug_m3 double, CO2_ppm double, Is_Exceeding_QCVN boolean, Is_Rush_Hour boolean",
        ("01", 40, 20.0, 400.0, False, True), ("01", 180, 60.0, 420.0, True, True), ("01", 170, 55.0, 440.0, True, False),
    )


def test_air(hourly):
    found = measures.measure(hourly, list(measures.AIR), ["Province_Code"]).first()
    assert found.Avg_AQI_Index == 130.0 and found.AQI_Status_Color_Hex == "#F97316"
    assert found.Exceeding_QCVN_Hours == 2 and found.Rush_Hour_Exceeding_Hours == 1
    assert found.Exceeding_QCVN_Rate == pytest.approx(2 / 3)
    empty = measures.measure(hourly.where("false"), list(measures.AIR)).first()
    assert empty.Exceeding_QCVN_Rate == 0.0 and empty.Avg_PM25 is None and empty.AQI_Status_Color_Hex == "#9CA3AF"


def test_narrative(provincial, hourly, places):
    air_hours = measures.measure(hourly, ["Exceeding_QCVN_Hours"], ["Province_Code"])
    found = by_key(measures.provincial_narrative(provincial, air_hours, places, F.lit(0.0001)), "Province_Code")
    lines = found["01"]["Narrative"].split("\n")
    assert lines[0] == "📌 DETAILED PROVINCIAL ANALYSIS: P01"
    assert lines[1] == "• Economic Scale: GRDP reached 400.0 Billion VND; Total GHG Emissions: 0.00 Million Tonnes CO2e."
    assert lines[2] == "• Tapio Decoupling Index: 51.00 pts — Classification: Negative Decoupling (Carbon Intensive)."
    assert lines[3] == "• 2030 Quota Realization: Currently at 137.5% of allocated Net-Zero 2030 target quota."
    assert lines[4].endswith("Recorded 2 hours exceeding QCVN 05:2023 safety thresholds.")
    assert lines[5] == "" and len(lines) == 10
    assert "GRDP reached  Billion VND" in found["04"]["Narrative"] and "No Data" in found["04"]["Narrative"]
    assert found["04"]["Card_Title"].endswith(": P04")


def test_selected_value(provincial):
    title = measures.card_title(measures.selected_value("Province_Name", k.NO_SELECTION))
    found = by_key(provincial.groupBy("Year").agg(title.alias("t")), "Year")
    assert found[2023]["t"].endswith(": P01") and found[2024]["t"].endswith(": " + k.NO_SELECTION)


def test_elasticity_variant(provincial):
    found = variants.tapio_elasticity(provincial, ["Province_Code"]).collect()
    assert len(found) == 1 and found[0].Elasticity == pytest.approx((10 / 50) / (200 / 100))
