"""The 37 report measures.

Base measures are aggregate expressions for any grouping. Measures that look at other years or at
all provinces need a grain, so they are built by the functions below from one shared aggregate.
All of them leave in double precision; sums are taken before the conversion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as k
from ..functions import air, bands, ratios
from ..operators.lookup import star


def _sum(column: str) -> Column:
    return F.sum(column).cast("double")


def _mean(column: str) -> Column:
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def _gdp() -> Column:
    return F.max(F.when(F.col("Sector_Code") == k.TOTAL_SECTOR, F.col("GDP_USD"))).cast("double")


def _intensity(ghg: Column, gdp: Column) -> Column:
    return ratios.divide(ghg * 1000000.0, ratios.divide(gdp, F.lit(1000000.0)))


# Aggregates over the national view. All sectors, the total row and all gases are summed as they are.
NATIONAL = {
    "Total_GHG_Emissions": lambda: _sum("Emissions_MtCO2e"),
    "Total_CO2_Emissions": lambda: _sum("CO2_MtCO2e"),
    "Total_Methane_Emissions": lambda: _sum("Methane_MtCO2e"),
    "National_GDP": _gdp,
    "National_Emission_Intensity": lambda: _intensity(_sum("Emissions_MtCO2e"), _gdp()),
    "Renewable_Energy_Pct": lambda: _mean("Renewable_Energy_Pct"),
}
# Corrected variants: total row and one gas only, so that nothing is counted twice.
NATIONAL_GUARDED = {
    "Total_GHG_Emissions_guarded": "Emissions_MtCO2e",
    "Total_CO2_Emissions_guarded": "CO2_MtCO2e",
    "Total_Methane_Emissions_guarded": "Methane_MtCO2e",
}
PROVINCIAL = {
    "Provincial_Carbon_Tonnes": lambda: _sum("Estimated_Carbon_Tonnes"),
    "Provincial_GRDP": lambda: _sum("GRDP_Billion_VND"),
    "Provincial_Population": lambda: F.sum("Population").cast("double"),
    "Provincial_Decoupling_Index": lambda: _mean("Decoupling_Index"),
    "Carbon_Intensity": lambda: ratios.divide(_sum("Estimated_Carbon_Tonnes"), _sum("GRDP_Billion_VND")),
    "Carbon_Per_Capita": lambda: ratios.divide(_sum("Estimated_Carbon_Tonnes"), _sum("Population")),
    "Forest_Coverage_Pct": lambda: _mean("Forest_Coverage_Pct"),
    "Decoupling_Color_Hex": lambda: bands.status_color(_mean("Decoupling_Index")),
    "Decoupling_Status_Label": lambda: bands.status_label(_mean("Decoupling_Index")),
}
AIR = {
    "Avg_AQI_Index": lambda: _mean("AQI_Index"),
    "Avg_PM25": lambda: _mean("PM25_ug_m3"),
    "Avg_CO2_Concentration": lambda: _mean("CO2_ppm"),
    "Exceeding_QCVN_Hours": lambda: F.sum(F.col("Is_Exceeding_QCVN").cast("int")),
    "Exceeding_QCVN_Rate": lambda: F.coalesce(
        F.try_divide(F.sum(F.col("Is_Exceeding_QCVN").cast("int")).cast("double"), F.count(F.lit(1))), F.lit(0.0)
    ),
    "Rush_Hour_Exceeding_Hours": lambda: F.sum(
        F.when(F.col("Is_Rush_Hour"), F.col("Is_Exceeding_QCVN").cast("int"))
    ),
    "AQI_Status_Color_Hex": lambda: air.aqi_color(_mean("AQI_Index")),
}
BASE = {**NATIONAL, **PROVINCIAL, **AIR}


#: Measures that set a filter of their own on a column. It takes the place of the grouping by that column, so the
#: measure is the same for all its values.
OWN_FILTER = {
    "National_GDP": "Sector_Code",
    "National_Emission_Intensity": "Sector_Code",
    "Rush_Hour_Exceeding_Hours": "Is_Rush_Hour",
}


def with_whole(rows: DataFrame, view: DataFrame, by: Sequence[str], column: str, measures: dict[str, Column]) -> DataFrame:
    """Adds (or replaces) ``measures`` of ``view``, grouped by ``by`` without ``column``, to rows that have ``by``."""
    rest = [c for c in by if c != column]
    whole = view.groupBy(*rest).agg(*(m.alias(f"_w_{name}") for name, m in measures.items()))
    rows = rows.drop(*measures)
    if not rest:
        return rows.select("*", *(whole.select(f"_w_{name}").scalar().alias(name) for name in measures))
    whole = whole.select(*(F.col(c).alias(f"_k_{c}") for c in rest), *(F.col(f"_w_{n}").alias(n) for n in measures))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in rest]
    return rows.join(whole, same, "left").drop(*(f"_k_{c}" for c in rest))


def measure(
    view: DataFrame, names: Sequence[str], by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Any base measures of one view at any grain: filter, then one aggregate.

    A measure that filters a column of ``by`` itself is aggregated without that column and joined back.
    """
    rows = view if where is None else view.where(where)
    out = rows.groupBy(*by).agg(*(BASE[name]().alias(name) for name in names))
    if "Sector_Code" in by and {"National_GDP", "National_Emission_Intensity"} & {*names}:
        out = with_whole(out, rows, by, "Sector_Code", {"National_GDP": _gdp()})
        if "National_Emission_Intensity" in names:
            if "Total_GHG_Emissions" not in names:
                ghg = rows.groupBy(*by).agg(_sum("Emissions_MtCO2e").alias("Total_GHG_Emissions"))
                out = out.join(ghg, [out[c].eqNullSafe(ghg[c]) for c in by], "left").drop(*(ghg[c] for c in by))
            intensity = _intensity(F.col("Total_GHG_Emissions"), F.col("National_GDP"))
            out = out.withColumn("National_Emission_Intensity", intensity)
    if "Is_Rush_Hour" in by and "Rush_Hour_Exceeding_Hours" in names:
        out = with_whole(out, rows, by, "Is_Rush_Hour", {"Rush_Hour_Exceeding_Hours": BASE["Rush_Hour_Exceeding_Hours"]()})
    return out.select(*by, *names)


AVERAGED = {"Avg_AQI_Index": "AQI_Index", "Avg_PM25": "PM25_ug_m3", "Avg_CO2_Concentration": "CO2_ppm"}


def air_measures(
    fact: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
    provinces: DataFrame,
    stations: DataFrame,
    by: Sequence[str],
    presum: bool = False,
) -> DataFrame:
    """All air measures by columns of the dimensions, in one aggregate over the star.

    The dimensions are broadcast as long as Spark finds them small, and partial sums absorb a hot key before the one
    shuffle. With ``presum``, for a station dimension that must be shuffled, readings are summed per surrogate key
    first, so that the joins see one row per year, hour and station.
    """
    rows = fact.select(
        "Date_Key",
        "Time_Key",
        "Province_Key",
        "Station_Key",
        *(F.col(c).alias(f"{c}_sum") for c in AVERAGED.values()),
        *(F.col(c).isNotNull().cast("int").alias(f"{c}_n") for c in AVERAGED.values()),
        F.col("Is_Exceeding_QCVN").cast("int").alias("exceeding"),
        F.lit(1).alias("readings"),
    )
    if presum:
        keys = ["Date_Key", "Time_Key", "Province_Key", "Station_Key"]
        rows = rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in rows.columns if c not in keys))
    rows = star(rows, (dates.select("Date_Key", "Year"), "Date_Key"), (hours, "Time_Key"), (provinces, "Province_Key"))
    places = stations.drop("Province_Key")
    rows = rows.join(places, "Station_Key")

    def mean(column: str) -> Column:
        return F.try_divide(F.sum(f"{column}_sum").cast("double"), F.sum(f"{column}_n"))

    rate = F.try_divide(F.sum("exceeding").cast("double"), F.sum("readings"))
    rush = F.sum(F.when(F.col("Is_Rush_Hour"), F.col("exceeding")))
    out = rows.groupBy(*by).agg(
        *(mean(column).alias(name) for name, column in AVERAGED.items()),
        F.sum("exceeding").alias("Exceeding_QCVN_Hours"),
        F.coalesce(rate, F.lit(0.0)).alias("Exceeding_QCVN_Rate"),
        rush.alias("Rush_Hour_Exceeding_Hours"),
        air.aqi_color(mean("AQI_Index")).alias("AQI_Status_Color_Hex"),
    )
    if "Is_Rush_Hour" not in by:
        return out
    return with_whole(out, rows, by, "Is_Rush_Hour", {"Rush_Hour_Exceeding_Hours": rush}).select(*out.columns)


def guarded(view: DataFrame, by: Sequence[str] = (), gas: str = k.ALL_GASES) -> DataFrame:
    rows = view.where((F.col("Sector_Code") == k.TOTAL_SECTOR) & (F.col("Gas") == gas))
    return rows.groupBy(*by).agg(*(_sum(c).alias(n) for n, c in NATIONAL_GUARDED.items()))


def target_emission(baseline: Column, cut: float = k.TARGET_CUT) -> Column:
    return baseline * (1 - cut)


def formatted(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def gap_subtitle(gap: Column) -> Column:
    def text(value: Column, parts) -> Column:
        shown = formatted(F.round(value, 1), "#,##0.0")
        return F.concat(F.lit(parts[0]), shown, F.lit(parts[1]))

    return (
        F.when(gap.isNull(), k.GAP_NONE)
        .when(gap <= 0, text(F.abs(gap), k.GAP_WITHIN))
        .otherwise(text(gap, k.GAP_OVER))
    )


def card_title(selected: Column) -> Column:
    return F.concat(F.lit(k.CARD_TITLE), selected)


def selected_value(column: str, default: str) -> Column:
    """The one value of the current rows, or ``default`` when there are several (a NULL is one) or none."""
    one = (F.min(column) == F.max(column)) & (F.count(column) == F.count(F.lit(1)))
    return F.when(one, F.min(column)).otherwise(F.lit(default))


def national_by_year(
    view: DataFrame,
    dates: DataFrame,
    by: Sequence[str] = (),
    baseline_year: int = k.BASELINE_YEAR,
    cut: float = k.TARGET_CUT,
) -> DataFrame:
    """National measures per year of the calendar (and per ``by``, each compared with itself).

    The baseline applies to every year, so every calendar year is a row: without emissions the gap
    is minus the target, and growth after a year with emissions is -100 %. Windows see one row per
    calendar year and ``by`` value.
    """
    sums = measure(view, list(NATIONAL), by=["Year", *by])
    if by:
        calendar = F.explode(F.sequence(F.lit(k.FIRST_YEAR), F.lit(k.LAST_YEAR)))
        spine = sums.select(*by).distinct().withColumn("Year", calendar).join(dates.select("Year"), "Year")
        if "Sector_Code" in by:  # known for every sector of a year, also one without rows in it
            spine = with_whole(spine, view, ["Year", *by], "Sector_Code", {"National_GDP": _gdp()})
            sums = sums.drop("National_GDP")
    else:
        spine = dates.select("Year")
    ordered = Window.partitionBy(*by).orderBy("Year")
    ghg = F.col("Total_GHG_Emissions")

    def back(years: int) -> Column:
        return F.sum(ghg).over(ordered.rangeBetween(-years, -years))

    baseline = F.sum(F.when(F.col("Year") == baseline_year, ghg)).over(Window.partitionBy(*by))
    target = target_emission(F.col("Baseline_Emissions"), cut)
    gap = ratios.blank_minus(ghg, F.col("Target_Emission"))
    return (
        spine.join(sums, ["Year", *by], "left")
        .select(
            "*",
            back(1).alias("Emissions_Prior_Year"),
            back(k.CAGR_YEARS).alias("_base"),
            baseline.alias("Baseline_Emissions"),
        )
        .withColumn("Emissions_YoY_Growth", ratios.growth(ghg, F.col("Emissions_Prior_Year")))
        .withColumn("Emissions_CAGR_5Y", ratios.cagr(ghg, F.col("_base"), k.CAGR_YEARS))
        .withColumn("Target_Emission", target)
        .withColumn("Target_Gap", gap)
        .withColumn("KPI_Subtitle", gap_subtitle(F.col("Target_Gap")))
        .drop("_base")
    )


def baseline_target(
    national: DataFrame, baseline_year: int = k.BASELINE_YEAR, cut: float = k.TARGET_CUT
) -> Column:
    """The target as a scalar subquery, for use in provincial measures."""
    rows = national.where(F.col("Year") == baseline_year)
    return rows.agg(target_emission(_sum("Emissions_MtCO2e"), cut).alias("target")).scalar()


def quota(grdp: Column, total_grdp: Column, target: Column) -> Column:
    """The target in tonnes times the share of GRDP; the share is 0 where there is no GRDP at all."""
    return target * 1000000.0 * ratios.divide(grdp, total_grdp, 0.0)


def provincial_by_year(
    view: DataFrame,
    dim_province: DataFrame,
    dates: DataFrame,
    target: Column,
    by: Sequence[str] = ("Province_Code",),
) -> DataFrame:
    """Provincial measures per calendar year and ``by`` (columns of the province dimension).

    Every calendar year is a row, so growth after a year with GRDP is -100 %. Area comes from the
    dimension, once per province, however many years or facts there are. Windows see one row per
    calendar year and ``by`` value.
    """
    names = [n for n in PROVINCIAL if n not in ("Decoupling_Color_Hex", "Decoupling_Status_Label")]
    sums = view.groupBy("Year", *by).agg(
        *(BASE[name]().alias(name) for name in names), F.sum("GRDP_Billion_VND").alias("_grdp")
    )
    totals = sums.groupBy("Year").agg(_sum("_grdp").alias("_all"))
    places = dim_province.groupBy(*by).agg(_sum("Area_Km2").alias("_area"))
    calendar = F.explode(F.sequence(F.lit(k.FIRST_YEAR), F.lit(k.LAST_YEAR)))
    spine = places.withColumn("Year", calendar).join(dates.select("Year"), "Year")
    carbon, grdp, index = (
        F.col(c) for c in ("Provincial_Carbon_Tonnes", "Provincial_GRDP", "Provincial_Decoupling_Index")
    )
    prior = F.sum(grdp).over(Window.partitionBy(*by).orderBy("Year").rangeBetween(-1, -1))
    return (
        spine.join(sums, ["Year", *by], "left")
        .join(totals, "Year", "left")
        .withColumn("GRDP_Prior_Year", prior)
        .withColumn("Carbon_Density", ratios.divide(carbon, F.col("_area")))
        .withColumn("GRDP_YoY_Growth", ratios.growth(grdp, F.col("GRDP_Prior_Year")))
        .withColumn("Provincial_Emission_Quota", quota(grdp, F.col("_all"), target))
        .withColumn("Provincial_Quota_Carbon_Tonnes", F.col("Provincial_Emission_Quota"))
        .withColumn("Quota_Realization", ratios.divide(carbon, F.col("Provincial_Emission_Quota")))
        .withColumn("Decoupling_Color_Hex", bands.status_color(index))
        .withColumn("Decoupling_Status_Label", bands.status_label(index))
        .drop("_area", "_all", "_grdp")
    )


def narrative(name: Column, grdp: Column, carbon: Column, index: Column, realization: Column, hours: Column) -> Column:
    """The report text; a missing number is shown as empty."""

    def shown(value: Column, digits: int, pattern: str) -> Column:
        return F.coalesce(formatted(F.round(value.cast("double"), digits), pattern), F.lit(""))

    def sentence(parts, *values: Column) -> Column:
        pieces = [F.lit(parts[0])]
        for value, part in zip(values, parts[1:]):
            pieces += [value, F.lit(part)]
        return F.concat(*pieces)

    # divided with alternate 0 only for a zero divisor, so a missing sum stays empty
    megatonnes = shown(carbon.cast("double") / 1000000.0, 2, "#,##0.00")
    percent = F.coalesce(
        F.concat(formatted(F.round(realization * 100, 1), "0.0"), F.lit("%")), F.lit("")
    )
    return F.concat_ws(
        "\n",
        F.concat(F.lit(k.NARRATIVE_TITLE), F.upper(name)),
        sentence(k.NARRATIVE_ECONOMY, shown(grdp, 1, "#,##0.0"), megatonnes),
        sentence(k.NARRATIVE_INDEX, shown(index, 2, "0.00"), bands.status_label(index)),
        sentence(k.NARRATIVE_QUOTA, percent),
        sentence(k.NARRATIVE_AIR, shown(hours, 0, "#,##0")),
        F.lit(""),
        *(F.lit(line) for line in k.NARRATIVE_ADVICE),
    )


def provincial_narrative(
    provincial: DataFrame, air_hours: DataFrame, dim_province: DataFrame, target: Column
) -> DataFrame:
    """(Province_Code, Province_Name, Card_Title, Narrative) for each province selected on its own.

    ``air_hours`` has the air measures per province. Facts are aggregated per province before they
    meet; provinces without facts still get a text.
    The window for the country's GRDP sees one row per province of the dimension.
    """
    names = ["Provincial_GRDP", "Provincial_Carbon_Tonnes", "Provincial_Decoupling_Index"]
    economy = provincial.groupBy("Province_Code").agg(
        *(BASE[name]().alias(name) for name in names), F.sum("GRDP_Billion_VND").alias("_grdp")
    )
    total = F.sum("_grdp").over(Window.partitionBy()).cast("double")
    carbon, grdp = F.col("Provincial_Carbon_Tonnes"), F.col("Provincial_GRDP")
    realization = ratios.divide(carbon, quota(grdp, total, target))
    return (
        dim_province.select("Province_Code", "Province_Name")
        .join(economy, "Province_Code", "left")
        .join(air_hours.select("Province_Code", "Exceeding_QCVN_Hours"), "Province_Code", "left")
        .select(
            "Province_Code",
            "Province_Name",
            card_title(F.col("Province_Name")).alias("Card_Title"),
            narrative(
                F.col("Province_Name"),
                grdp,
                carbon,
                F.col("Provincial_Decoupling_Index"),
                realization,
                F.col("Exceeding_QCVN_Hours"),
            ).alias("Narrative"),
        )
    )
