"""Top-down allocation of national totals to provinces, and the population projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import constants as k


def national_series(spark: SparkSession, grdp=k.NATIONAL_GRDP, ghg=k.NATIONAL_GHG) -> DataFrame:
    """(Year, GRDP, GHG): the fixed national totals."""
    rows = [(year, float(grdp[year]), float(ghg[year])) for year in sorted(set(grdp) & set(ghg))]
    return spark.createDataFrame(rows, "Year int, GRDP double, GHG double")


def base_population(spark: SparkSession, thousands=k.BASE_POPULATION_THOUSANDS) -> DataFrame:
    """(Province_Code, base_thousands): the fixed base populations."""
    return spark.createDataFrame(sorted(thousands.items()), "Province_Code string, base_thousands int")


CATALOG_NAMES = {
    "code": "Province_Code",
    "name": "Province_Name",
    "ascii": "Province_Name_Ascii",
    "region": "Region",
    "zone": "Economic_Zone",
    "area": "Area_Km2",
    "hub": "Is_Industrial_Hub",
}


def catalog_dimension(catalog: DataFrame) -> DataFrame:
    """The dimension part of an allocation catalog: its own column names, without the share."""
    return catalog.withColumnsRenamed(CATALOG_NAMES).drop("grdp_share")


def with_years(catalog: DataFrame, first: int | Column, last: int | Column, year: str = "Year") -> DataFrame:
    """Every catalog row once per year, without a join; the years may be scalar subqueries over the data."""
    return catalog.withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))


def allocate_by_share(
    catalog: DataFrame,
    national: DataFrame,
    share: str,
    is_hub: Column,
    missing_grdp=k.NATIONAL_GRDP_MISSING,
    missing_ghg=k.NATIONAL_GHG_MISSING,
) -> DataFrame:
    """Adds GRDP, carbon (Mt and tonnes) and intensity index to (Year, …, share) rows.

    ``national`` is (Year, GRDP, GHG), one row per year; a year it lacks takes the missing-year
    values. Shares times weights need not sum to 1; see :func:`normalised_weight`.
    """
    weight = F.col(share) * F.when(is_hub, F.lit(k.HUB_WEIGHT)).otherwise(F.lit(k.OTHER_WEIGHT))
    grdp = F.coalesce(F.col("_grdp").cast("double"), F.lit(float(missing_grdp)))
    ghg = F.coalesce(F.col("_ghg").cast("double"), F.lit(float(missing_ghg)))
    totals = national.select("Year", F.col("GRDP").alias("_grdp"), F.col("GHG").alias("_ghg"))
    return (
        catalog.join(totals, "Year", "left")
        .withColumn("GRDP_Billion_VND", F.round(grdp * F.col(share), 2))
        .withColumn("Carbon_Mt", F.round(ghg * weight, 3))
        .withColumn("Estimated_Carbon_Tonnes", F.round(F.col("Carbon_Mt") * 1000000, 0))
        .withColumn(
            "Decoupling_Index",
            F.round(F.try_divide(F.col("Estimated_Carbon_Tonnes"), F.col("GRDP_Billion_VND")), 2),
        )
        .drop("_grdp", "_ghg")
    )


def normalised_weight(catalog: DataFrame, share: str, is_hub: Column, name: str = "weight") -> DataFrame:
    """Corrected variant: weights scaled to sum to 1 over the catalog."""
    raw = F.col(share) * F.when(is_hub, F.lit(k.HUB_WEIGHT)).otherwise(F.lit(k.OTHER_WEIGHT))
    return catalog.withColumn(name, F.try_divide(raw, catalog.agg(F.sum(raw)).scalar()))


def project_population(
    df: DataFrame,
    base: DataFrame,
    code: str,
    area: Column,
    year: Column,
    base_year: int = k.POPULATION_BASE_YEAR,
    growth: float = k.POPULATION_GROWTH,
) -> DataFrame:
    """Adds Population: base (thousands, by ``code``) grown linearly; without a base one from the area."""
    joined = df.join(base.select(code, F.col("base_thousands").alias("_base")), code, "left")
    fallback = F.floor(area.cast("double") * k.POPULATION_PER_KM2 + k.POPULATION_FLOOR)
    people = F.coalesce(F.col("_base"), fallback) * 1000 * (1.0 + (year - base_year) * growth)
    return joined.withColumn("Population", F.floor(people).cast("long")).drop("_base")
