"""The warehouse tables derived from a generic sales schema, so that every operator runs on real rows.

nation and region stand for provinces, part types for sectors, orders and lineitem for yearly
economy and emissions, events for hourly readings. Doubles become decimals before they are summed.
Large tables are summed per key before each join: a key with very many rows reaches the join as a
few rows. The yearly tables that come out are small by construction (years times provinces, years
times sectors times gases) and are kept, since most plans use them several times.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import constants as k
from ..operators.generators import dim_date, dim_time_of_day
from ..operators.keys import dense_keys
from ..operators.series import pivot_first
from . import facts, measures, views

# The parameters that take the place of the calendar and gas values of the original data.
BASELINE_YEAR, QUADRANT_YEAR, FIRST_SHARE_YEAR = 1996, 2000, 1996
GAS, GASES = "N", ("A", "N", "R")
COMMON_YEARS = (1996, 2000)
CARBON_PER_UNIT = 250_000
INDICATOR_OF_PRIORITY = {
    "1-URGENT": "CO2_MtCO2e",
    "2-HIGH": "GDP_USD",
    "3-MEDIUM": "Methane_MtCO2e",
    "4-NOT SPECIFIED": "Renewable",
    "5-LOW": "Total_GHG_MtCO2e",
}
STATION_TYPES = ("Khu Công Nghiệp", "Đô Thị Giao Thông", "Vùng Đệm Sinh Thái")


# Columns in use, so that opening a table needs no job to find its schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def hundredths(column: str) -> Column:
    """An amount with two decimals as a whole number: sums of it are plain long additions."""
    return F.rint(F.col(column) * 100).cast("long")


def amount(total: Column) -> Column:
    """A sum of hundredths as a decimal."""
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,4)")


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,4)")


def province_code(key: Column) -> Column:
    return F.lpad(key.cast("string"), 2, "0")


class StandIn:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- dimensions --------------------------------------------------------
    @cached_property
    def dates(self) -> DataFrame:
        return dim_date(self.spark)

    @cached_property
    def hours(self) -> DataFrame:
        return dim_time_of_day(self.spark)

    @cached_property
    def provinces(self) -> DataFrame:
        nation = self.table("nation")
        key = F.col("n_nationkey")
        rows = nation.join(self.table("region"), nation.n_regionkey == F.col("r_regionkey")).select(
            (key + 1).cast("int").alias("Province_Key"),
            province_code(key).alias("Province_Code"),
            F.col("n_name").alias("Province_Name"),
            F.lower("n_name").alias("Province_Name_Ascii"),
            F.col("r_name").alias("Region"),
            F.concat(F.lit("ZONE_"), (key % 3).cast("string")).alias("Economic_Zone"),
            (F.lit(1000) + key * 10).cast("decimal(10,2)").alias("Area_Km2"),
            (key % 2 == 0).alias("Is_Industrial_Hub"),
        )
        return rows

    @cached_property
    def sector_codes(self) -> DataFrame:
        """Part types and the code of the total."""
        both = F.explode(F.array("p_type", F.lit(k.TOTAL_SECTOR)))
        return self.table("part").select(both.alias("Sector_Code")).distinct()

    @cached_property
    def sectors(self) -> DataFrame:
        code = F.col("Sector_Code")
        keyed = dense_keys(self.sector_codes, "Sector_Code", "Sector_Key")
        return keyed.select(
            F.col("Sector_Key").cast("int").alias("Sector_Key"),
            "Sector_Code",
            F.initcap(code).alias("Sector_Name_EN"),
            F.concat(F.lit("Ngành "), F.lower(code)).alias("Sector_Name_VI"),
            F.when(code.isin("ECONOMY", "STANDARD", "PROMO"), "Basic").otherwise("Sized").alias("Sector_Category"),
            F.when(code == k.TOTAL_SECTOR, "Scope 1/2/3").when(code.isin("PROMO", "LARGE"), "Scope 1").alias("Scope_Type"),
        ).persist()

    @cached_property
    def staged_stations(self) -> DataFrame:
        user = F.col("user_id")
        return self.table("events").select("user_id").distinct().select(
            self.station_code(user).alias("Station_Code"),
            F.concat(F.lit("Trạm "), user.cast("string")).alias("Station_Name"),
            province_code(user % 25).alias("Province_Code"),
            F.get(F.array(*(F.lit(t) for t in STATION_TYPES)), (user % 3).cast("int")).alias("Station_Type"),
            (F.lit(8) + (user % 1000) * F.lit(0.01)).cast("decimal(9,6)").alias("Latitude"),
            (F.lit(102) + (user % 1000) * F.lit(0.01)).cast("decimal(9,6)").alias("Longitude"),
            (user % 10 != 0).alias("Is_Active"),
        )

    @staticmethod
    def station_code(user: Column) -> Column:
        return F.concat(F.lit("ST-"), user.cast("string"))

    @cached_property
    def stations(self) -> DataFrame:
        rows = facts.station_rows(self.staged_stations, self.provinces)
        key = F.substring("Station_Code", 4, 20).cast("long") + 1
        return rows.select(key.alias("Station_Key"), "*")

    # --- staged yearly rows --------------------------------------------------
    @cached_property
    def economy(self) -> DataFrame:
        """(Year, Province_Code, measures): lineitem per order, orders per customer and year, then nations."""
        carbon = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum(hundredths("l_quantity")).alias("q")
        )
        orders = self.table("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("c_custkey"),
            F.year("o_orderdate").alias("Year"),
            hundredths("o_totalprice").alias("price"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"),
            (F.col("o_orderstatus") == "F").alias("done"),
        )
        per_customer = (
            orders.join(carbon, "o_orderkey", "left")
            .groupBy("c_custkey", "Year")
            .agg(
                F.sum("price").alias("price"),
                F.sum(F.when(F.col("urgent"), F.col("price"))).alias("urgent"),
                F.sum("q").alias("q"),
                F.count_if("done").alias("done"),
                F.count(F.lit(1)).alias("n"),
            )
        )
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        per_nation = (
            per_customer.join(customers, "c_custkey")
            .groupBy("c_nationkey", "Year")
            .agg(
                F.sum(amount(F.col("price"))).alias("GRDP_Billion_VND"),
                F.count(F.lit(1)).alias("Population"),
                F.coalesce(F.sum(amount(F.col("urgent"))), F.lit(0)).alias("Industrial_Output_Billion_VND"),
                F.round(F.sum("done") * 100.0 / F.sum("n"), 2).cast("decimal(5,2)").alias("Forest_Coverage_Pct"),
                F.coalesce(F.sum(amount(F.col("q"))) * CARBON_PER_UNIT, F.lit(0)).alias("Estimated_Carbon_Tonnes"),
            )
        )
        index = F.try_divide(F.col("Estimated_Carbon_Tonnes").cast("double"), F.col("GRDP_Billion_VND").cast("double"))
        # 20 whole digits are enough for any sum here and leave 14 decimals to a quotient
        wide = "decimal(24,4)"
        return per_nation.select(
            "Year",
            province_code(F.col("c_nationkey")).alias("Province_Code"),
            F.col("GRDP_Billion_VND").cast(wide).alias("GRDP_Billion_VND"),
            "Population",
            F.col("Industrial_Output_Billion_VND").cast(wide).alias("Industrial_Output_Billion_VND"),
            "Forest_Coverage_Pct",
            F.col("Estimated_Carbon_Tonnes").cast(wide).alias("Estimated_Carbon_Tonnes"),
            F.round(index, 4).alias("Decoupling_Index"),
        ).persist()

    @cached_property
    def sector_emissions(self) -> DataFrame:
        """(Year, Sector_Code, Gas, Emissions): lineitem per part, year and gas first; total rows on top."""
        per_part = self.table("lineitem").groupBy(
            F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").alias("Year"), F.col("l_returnflag").alias("Gas")
        ).agg(F.sum(hundredths("l_extendedprice")).alias("v"))
        types = self.table("part").select("p_partkey", "p_type")
        both = F.explode(F.array("p_type", F.lit(k.TOTAL_SECTOR)))
        return (
            per_part.join(types, "p_partkey")
            .groupBy("p_type", "Year", "Gas")
            .agg(F.sum(amount(F.col("v"))).alias("v"))
            .select("Year", "Gas", "v", both.alias("Sector_Code"))
            .groupBy("Year", "Sector_Code", "Gas")
            .agg(F.sum("v").alias("Emissions_MtCO2e"))
            .persist()
        )

    @cached_property
    def indicator_rows(self) -> DataFrame:
        """(Year, Indicator, Value) from orders by year and priority."""
        pairs = F.create_map(*(F.lit(x) for pair in INDICATOR_OF_PRIORITY.items() for x in pair))
        return (
            self.table("orders")
            .groupBy(F.year("o_orderdate").alias("Year"), "o_orderpriority")
            .agg(amount(F.sum(hundredths("o_totalprice"))).alias("Value"))
            .select("Year", F.try_element_at(pairs, F.col("o_orderpriority")).alias("Indicator"), "Value")
        )

    @cached_property
    def national(self) -> DataFrame:
        names = list(INDICATOR_OF_PRIORITY.values())
        wide = pivot_first(self.indicator_rows, "Year", "Indicator", "Value", names, ["Value"])
        whole = sum((F.coalesce(F.col(n), F.lit(0)) for n in names[1:]), F.coalesce(F.col(names[0]), F.lit(0)))
        share = F.try_divide(F.col("Renewable").cast("double") * 100, whole.cast("double"))
        return wide.select(
            "Year",
            "CO2_MtCO2e",
            "Methane_MtCO2e",
            "GDP_USD",
            "Total_GHG_MtCO2e",
            F.round(share, 2).cast("decimal(5,2)").alias("Renewable_Energy_Pct"),
        ).persist()

    # --- hourly readings -----------------------------------------------------
    @cached_property
    def readings(self) -> DataFrame:
        return self.readings_of(self.table("events"))

    def readings_of(self, events: DataFrame) -> DataFrame:
        ts, user, value = F.col("ts"), F.col("user_id"), F.col("value")
        kk = F.get_json_object("props", "$.k").cast("int")
        raw = events.select(
            "event_id",
            F.year(ts).alias("Date_Key"),
            F.year(ts).alias("Year"),
            F.month(ts).cast("short").alias("Month"),
            F.dayofmonth(ts).cast("short").alias("Day"),
            F.hour(ts).cast("short").alias("Hour_24"),
            self.station_code(user).alias("Station_Code"),
            province_code(user % 25).alias("Province_Code"),
            (F.lit(400) + value).cast("decimal(8,2)").alias("CO2_ppm"),
            (kk * F.lit(0.01)).cast("decimal(6,2)").alias("CO_mg_m3"),
            kk.cast("decimal(6,2)").alias("NO2_ug_m3"),
            (kk + F.lit(1)).cast("decimal(6,2)").alias("SO2_ug_m3"),
            value.cast("decimal(6,2)").alias("PM25_ug_m3"),
            (value.cast("decimal(6,2)") * 2).cast("decimal(6,2)").alias("PM10_ug_m3"),
        )
        return facts.with_air_index(raw)

    # --- facts and views -----------------------------------------------------
    @cached_property
    def national_fact(self) -> DataFrame:
        return facts.national_fact(self.sector_emissions, self.dates, self.sectors, self.national, GASES)

    @cached_property
    def provincial_fact(self) -> DataFrame:
        return facts.provincial_fact(self.economy, self.dates, self.provinces)

    @cached_property
    def hourly_fact(self) -> DataFrame:
        return facts.hourly_fact(
            self.readings,
            self.dates,
            self.hours,
            self.provinces,
            self.stations,
            row_id=F.col("event_id"),
        )

    @cached_property
    def national_view(self) -> DataFrame:
        return views.vw_fact_national(self.national_fact, self.dates, self.sectors)

    @cached_property
    def provincial_view(self) -> DataFrame:
        return views.vw_fact_provincial(self.provincial_fact, self.dates, self.provinces)

    @cached_property
    def hourly_view(self) -> DataFrame:
        return views.vw_fact_hourly(
            self.hourly_fact, self.dates, self.hours, self.provinces, self.stations
        )

    def air_measures(self, by: list[str]) -> DataFrame:
        return measures.air_measures(
            self.hourly_fact, self.dates, self.hours, self.provinces, self.stations, by
        )


@lru_cache(maxsize=8)
def stand_in(spark: SparkSession, sf_dir: str) -> StandIn:
    """One set of plans per session and folder, shared by the queries."""
    return StandIn(spark, sf_dir)
