"""Every operator as a query over the given tables.

Each query takes (spark, folder of parquet tables) and reads its tables whole. The result columns
are plain BIGINT, DOUBLE, VARCHAR, BOOLEAN or DATE, so that any SQL engine can check them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegralType, LongType

from . import constants as k
from .functions import bands, calendar as cal, labels, ratios
from .functions.text import name_key
from .operators import allocation, audit, bucketed, generators, geography, lookup, merge, profiles, quality, rings, series
from .operators.constraints import Rule, non_negative, percentage, positive, required, violations
from .operators.keys import dense_keys
from .operators.ranking import share_within
from .plans import cuboids, facts, kpis, measures, standin, variants, views
from .plans.standin import StandIn, amount, hundredths, money, stand_in
from .session import scratch
from .sources import csvfiles, payloads, snapshots, tables, topology
from .streaming import hourly_feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Integers as BIGINT and decimals as DOUBLE; other types stay."""

    def shaped(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, IntegralType) and not isinstance(field.dataType, LongType):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return df.select(*(shaped(f) for f in df.schema))


def query(build: Callable[[StandIn], DataFrame]) -> Callable[[StandIn], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(stand_in(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


SECTOR_COLUMNS = ["Sector_Name_EN", "Sector_Name_VI", "Sector_Category"]
#: Queries that write tables (in a scratch folder) and read them again; the others only build a plan.
WRITING: set[str] = set()


def writing_query(build: Callable[[StandIn], DataFrame]) -> Callable[[StandIn], DataFrame]:
    WRITING.add(build.__name__)
    return query(build)


# --- analytic queries --------------------------------------------------------


@query
def top_emitters_latest_year(w: StandIn) -> DataFrame:
    return kpis.top_emitters_latest_year(w.provincial_view)


@query
def decade_trend(w: StandIn) -> DataFrame:
    return kpis.decade_trend(w.national_view)


@query
def sector_share_by_phase(w: StandIn) -> DataFrame:
    return kpis.sector_share_by_phase(w.national_view, standin.GAS, standin.FIRST_SHARE_YEAR)


@query
def quadrant_matrix(w: StandIn) -> DataFrame:
    return kpis.quadrant_matrix(w.provincial_view, standin.QUADRANT_YEAR)


# --- dimensions and views ------------------------------------------------------


@query
def dim_date(w: StandIn) -> DataFrame:
    shipped = w.table("lineitem").groupBy(F.year("l_shipdate").alias("Year")).agg(
        F.count(F.lit(1)).alias("Lines"), F.sum(money("l_quantity")).alias("Units")
    )
    return w.dates.join(shipped, "Year", "left").select(
        *w.dates.columns, F.coalesce("Lines", F.lit(0)).alias("Lines"), "Units"
    )


@query
def dim_time_of_day(w: StandIn) -> DataFrame:
    seen = w.table("events").groupBy(F.hour("ts").alias("Time_Key")).agg(F.count(F.lit(1)).alias("Readings"))
    return w.hours.join(seen, "Time_Key", "left").select(
        *w.hours.columns, F.coalesce("Readings", F.lit(0)).alias("Readings")
    )


@query
def vw_dim_date(w: StandIn) -> DataFrame:
    ordered = w.table("orders").groupBy(F.year("o_orderdate").alias("Year")).agg(F.count(F.lit(1)).alias("Orders"))
    view = views.vw_dim_date(w.dates)
    return view.join(ordered, "Year", "left").select(*view.columns, F.coalesce("Orders", F.lit(0)).alias("Orders"))


STANDIN_REGIONS = {"AFRICA": "Miền Bắc", "AMERICA": "Miền Trung", "ASIA": "Miền Nam"}


@query
def vw_dim_province(w: StandIn) -> DataFrame:
    people = w.table("customer").groupBy((F.col("c_nationkey") + 1).alias("Province_Key")).agg(
        F.count(F.lit(1)).alias("Customers")
    )
    view = views.vw_dim_province(w.provinces, STANDIN_REGIONS)
    return view.join(people, "Province_Key", "left").select(
        *view.columns, F.coalesce("Customers", F.lit(0)).alias("Customers")
    )


@query
def macro_region_variants(w: StandIn) -> DataFrame:
    """Literal map against the spelling-tolerant one, over the sources of all documents."""
    spelt = F.concat(F.initcap("lang"), F.lit(" & "), F.upper("source"))
    known = {"En và src1": "Miền Bắc", "FR VÀ SRC2": "Miền Trung", "De & SRC3": "Miền Nam"}
    return (
        w.table("documents")
        .groupBy(spelt.alias("Region"))
        .agg(F.count(F.lit(1)).alias("Documents"))
        .select(
            "Region",
            "Documents",
            labels.macro_region(F.col("Region"), known).alias("Macro_Region"),
            labels.macro_region_normalised(F.col("Region"), known).alias("Macro_Region_Normalised"),
        )
    )


@query
def vw_dim_sector(w: StandIn) -> DataFrame:
    parts = w.table("part").groupBy(F.col("p_type").alias("Sector_Code")).agg(F.count(F.lit(1)).alias("Parts"))
    view = views.vw_dim_sector(w.sectors)
    return view.join(parts, "Sector_Code", "left").select(*view.columns, F.coalesce("Parts", F.lit(0)).alias("Parts"))


@query
def vw_fact_national(w: StandIn) -> DataFrame:
    return w.national_view


@query
def vw_fact_provincial(w: StandIn) -> DataFrame:
    return w.provincial_view


@query
def vw_dim_station(w: StandIn) -> DataFrame:
    return views.vw_dim_station(w.stations, w.provinces)


@query
def vw_dim_time_of_day(w: StandIn) -> DataFrame:
    view = views.vw_dim_time_of_day(w.hours)
    seen = w.table("events").groupBy(F.hour("ts").alias("Time_Key")).agg(
        F.count(F.lit(1)).alias("Readings"), F.round(F.sum(money("value")).cast("double"), 4).alias("Total_Value")
    )
    return view.join(seen, "Time_Key", "left").select(
        *view.columns, F.coalesce("Readings", F.lit(0)).alias("Readings"), "Total_Value"
    )


@query
def vw_fact_hourly(w: StandIn) -> DataFrame:
    return w.hourly_view


# --- facts ---------------------------------------------------------------------


@query
def national_fact(w: StandIn) -> DataFrame:
    return w.national_fact


@query
def provincial_fact(w: StandIn) -> DataFrame:
    return w.provincial_fact


@query
def hourly_fact(w: StandIn) -> DataFrame:
    return w.hourly_fact


# --- projections -----------------------------------------------------------------


@query
def decade_label(w: StandIn) -> DataFrame:
    year = F.year("l_shipdate")
    return w.table("lineitem").groupBy(cal.decade(year).alias("Decade")).agg(
        F.count(F.lit(1)).alias("Lines"), F.sum(money("l_quantity")).alias("Units")
    )


@query
def plan_phase_band(w: StandIn) -> DataFrame:
    year = F.year("o_orderdate")
    return w.table("orders").groupBy(
        cal.plan_phase(year).alias("Five_Year_Plan_Phase"), cal.policy_period(year).alias("Policy_Period")
    ).agg(F.count(F.lit(1)).alias("Orders"), F.sum(money("o_totalprice")).alias("Total"))


@query
def hour_bucket_profile(w: StandIn) -> DataFrame:
    hour = F.hour("ts")
    return w.table("events").groupBy(
        cal.time_bucket(hour).alias("Time_Bucket"), cal.is_rush_hour(hour).alias("Is_Rush_Hour")
    ).agg(F.count(F.lit(1)).alias("Readings"), F.sum(money("value")).alias("Total_Value"))


@query
def overcount_guard(w: StandIn) -> DataFrame:
    """What a sum over the sector rows gives with and without the total-row guard."""
    rows = w.sector_emissions.join(w.national.select("Year", "GDP_USD"), "Year", "left")
    kept = ratios.total_row_guard(F.col("GDP_USD"), F.col("Sector_Code"), k.TOTAL_SECTOR)
    return rows.groupBy("Sector_Code").agg(
        F.sum(kept).alias("GDP_Guarded"), F.sum("GDP_USD").alias("GDP_Unsafe"), F.count(F.lit(1)).alias("Fact_Rows")
    )


@query
def intensity_ratios(w: StandIn) -> DataFrame:
    """Guarded ratios of every line, with natural zero denominators, summed per line number."""
    tax, discount, price = (money(c) for c in ("l_tax", "l_discount", "l_extendedprice"))
    per_unit = ratios.guarded_ratio(price, money("l_quantity"))
    per_discount = ratios.guarded_ratio(tax, discount)
    return w.table("lineitem").groupBy("l_linenumber").agg(
        F.sum(per_unit).alias("Price_Per_Unit"),
        F.sum(per_discount).alias("Tax_Per_Discount"),
        F.count_if(discount == 0).alias("Zero_Denominators"),
    )


@query
def tapio_band(w: StandIn) -> DataFrame:
    """The three index scales side by side over an index with negative and missing values."""
    index = F.try_divide(F.col("l_tax") - 0.02, F.col("l_discount"))
    return w.table("lineitem").groupBy(
        bands.tapio_band(index).alias("Tapio"),
        bands.green_band(index * 100).alias("Green"),
        bands.status_label(index).alias("Status"),
        bands.status_color(index).alias("Color"),
    ).agg(F.count(F.lit(1)).alias("Lines"))


STANDIN_SECTOR_MAP = {
    "ECONOMY": ("ENG", "Năng lượng & Khai khoáng", "Energy"),
    "LARGE": ("ELE", "Sản xuất Điện & Nhiệt", "Energy"),
    "MEDIUM": ("IND", "Công nghiệp Chế biến & Xây dựng", "Industry"),
    "PROMO": ("AGR", "Nông nghiệp & Trồng lúa nước", "Agriculture"),
}


@query
def code_map_default(w: StandIn) -> DataFrame:
    parts = w.table("part").groupBy(F.col("p_type").alias("Sector_Raw")).agg(F.count(F.lit(1)).alias("Parts"))
    return payloads.map_sectors(parts, mapping=STANDIN_SECTOR_MAP).drop("Sector_Raw")


@query
def blank_rule(w: StandIn) -> DataFrame:
    """The first number of every text line as a cell: blank where the line has none; numbers that no decimal holds are counted apart."""
    lines = w.table("documents").select("lang", F.explode(F.split("text", "\n")).alias("line"))
    cell = F.regexp_extract("line", "([0-9]+)", 1)
    too_long = csvfiles.unfit(cell, "decimal(38,0)")
    fitting = F.when(~too_long, cell)
    as_null = csvfiles.typed(fitting, "decimal(38,0)")
    as_zero = csvfiles.typed(fitting, "decimal(38,0)", 0)
    flag = csvfiles.typed(cell, csvfiles.BooleanType())
    return lines.groupBy("lang").agg(
        F.count(as_null).alias("Numbers"),
        F.count_if(too_long).alias("Unfit"),
        F.count_if(as_zero.isNotNull() & ~too_long).alias("Numbers_Or_Zero"),
        F.sum(F.pmod(as_zero, F.lit(1000003)).cast("long")).alias("Total"),
        F.count_if(flag).alias("Flags"),
    )


@query
def csv_quoted_cells(w: StandIn) -> DataFrame:
    """Customers written as CSV text with quotes, commas and doubled quotes, read by the reader's own options."""
    name = F.concat("c_name", F.lit(' "'), F.col("c_nationkey").cast("string"), F.lit('", x'))
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), quoted, F.col("c_nationkey").cast("string"))
    cells = csvfiles.parse_cells(w.table("customer").select(line.alias("line")), "line", ["code", "name", "nation"])
    return cells.select(csvfiles.typed(F.col("code"), "bigint").alias("code"), "name", csvfiles.typed(F.col("nation"), "bigint").alias("nation"))


@query
def bulk_lines_split(w: StandIn) -> DataFrame:
    """Text lines read as records of three comma-separated fields: short ones dropped, long ones kept."""
    lines = w.table("documents").select("lang", F.explode(F.split("text", "\n")).alias("line"))
    split = csvfiles.split_fields(lines, "line", ["a", "b", "c"])
    return split.groupBy("lang").agg(
        *csvfiles.line_counts(),
        F.sum(F.when(F.col("enough_fields"), F.length("b") + F.length("c"))).alias("field_chars"),
    )


# --- joins and sets --------------------------------------------------------------


@query
def ri_orphans(w: StandIn) -> DataFrame:
    """Documents without a label and labels without a document."""
    return lookup.key_difference(w.table("documents"), "doc_id", w.table("labels"), "doc_id")


@query
def ri_reference_counts(w: StandIn) -> DataFrame:
    customers = w.table("customer").select(F.col("c_custkey").alias("code"))
    users = w.table("events").select(F.col("user_id").alias("code"))
    return quality.reference_counts(users, "code", customers, "code", expected=None)


@query
def lookup_losses(w: StandIn) -> DataFrame:
    return lookup.lookup_losses(
        w.table("documents"), {"label": (w.table("labels"), "doc_id", "doc_id")}
    ).unionByName(
        lookup.lookup_losses(
            w.table("lineitem"),
            {
                "order": (w.table("orders"), "l_orderkey", "o_orderkey"),
                "part": (w.table("part"), "l_partkey", "p_partkey"),
                "station": (w.table("events").select("user_id").distinct(), "l_suppkey", "user_id"),
            },
        )
    )


@query
def common_years(w: StandIn) -> DataFrame:
    return quality.year_coverage(year_sources(w))


def year_sources(w: StandIn):
    return {
        "orders": (w.table("orders"), F.year("o_orderdate")),
        "lines": (w.table("lineitem"), F.year("l_shipdate")),
        "readings": (w.table("events"), F.year("ts") - 24),
    }


@query
def year_consistency(w: StandIn) -> DataFrame:
    coverage = quality.year_coverage(year_sources(w))
    return quality.year_consistency(coverage, standin.COMMON_YEARS, at_least=1)


# --- loads -------------------------------------------------------------------------


def merge_sides(w: StandIn) -> tuple[DataFrame, DataFrame]:
    """Suppliers, and customers that update and extend them; a negative balance counts as unknown."""
    target = w.table("supplier").select(
        (F.col("s_suppkey") + 1).alias("Member_Key"),
        F.col("s_suppkey").alias("Member_Code"),
        F.col("s_name").alias("Member_Name"),
        F.col("s_nationkey").alias("Nation"),
        F.col("s_acctbal").alias("Balance"),
        F.lit("Scope 1").alias("Scope_Type"),
    )
    source = w.table("customer").select(
        F.col("c_custkey").alias("Member_Code"),
        F.col("c_name").alias("Member_Name"),
        F.col("c_nationkey").alias("Nation"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("Balance"),
    )
    return target, source


MERGED = ["Member_Name", "Nation", "Balance"]
MERGE_OPTIONS = {"keep_if_null": ["Balance"], "insert_default": {"Balance": 0.0}}


@query
def scd1_merge(w: StandIn) -> DataFrame:
    target, source = merge_sides(w)
    return merge.scd1_merge(target, source, "Member_Code", MERGED, "Member_Key", **MERGE_OPTIONS)


@query
def dense_surrogate_keys(w: StandIn) -> DataFrame:
    return dense_keys(w.table("customer").select("c_custkey", "c_name"), "c_name", "Customer_Key", 100)


@query
def idempotent_reload(w: StandIn) -> DataFrame:
    """Orders as the loaded fact, lines shipped since 2000 as the staged years that replace it."""
    loaded = w.table("orders").select(
        F.year("o_orderdate").alias("Date_Key"), F.lit("loaded").alias("origin"), money("o_totalprice").alias("v")
    )
    staged = shipped_since(w, 2000).select(
        F.year("l_shipdate").alias("Date_Key"), F.lit("staged").alias("origin"), money("l_extendedprice").alias("v")
    )
    return merge.replace_slices(loaded, staged, "Date_Key").groupBy("Date_Key", "origin").agg(
        F.count(F.lit(1)).alias("Fact_Rows"), F.sum("v").alias("Total")
    )


def shipped_since(w: StandIn, year: int) -> DataFrame:
    """The bound is a literal of the column's own type, so that it reaches the files."""
    lines = w.table("lineitem")
    return lines.where(F.col("l_shipdate") >= F.lit(f"{year}-01-01").cast(lines.schema["l_shipdate"].dataType))


@query
def reload_by_staged_years(w: StandIn) -> DataFrame:
    """Years are replaced as staged: those of which every row is lost (odd ones here) end up without rows."""
    loaded = w.table("orders").select(F.year("o_orderdate").alias("Date_Key"), F.lit("loaded").alias("origin"))
    staged = shipped_since(w, 1996).select(F.year("l_shipdate").alias("Date_Key"), F.lit("staged").alias("origin"))
    rows = staged.where(F.col("Date_Key") % 2 == 0)
    replaced = merge.replace_slices(loaded, rows, "Date_Key", staged)
    return replaced.groupBy("Date_Key", "origin").agg(F.count(F.lit(1)).alias("Fact_Rows"))


@query
def fact_key_uniqueness(w: StandIn) -> DataFrame:
    """Rows and distinct surrogate keys of every fact."""
    facts = {
        "national": (w.national_fact, "Emission_ID"),
        "provincial": (w.provincial_fact, "Economy_ID"),
        "hourly": (w.hourly_fact, "Monitoring_ID"),
    }
    counts = [
        fact.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("Fact_Rows"), F.count(key).alias("Fact_Keys")
        ).select(F.lit(name).alias("fact"), "Fact_Rows", "Fact_Keys")
        for name, (fact, key) in facts.items()
    ]
    return quality.union_all(counts)


def order_rules() -> list[Rule]:
    return [positive("o_totalprice", null_ok=False), required("o_orderdate"), required("status")]


def labelled_documents(w: StandIn) -> DataFrame:
    return w.table("documents").join(w.table("labels"), "doc_id", "left")


@query
def constraint_violations(w: StandIn) -> DataFrame:
    """Natural violations: negative balances, missing labels, an unknown order status."""
    orders = w.table("orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    lines = w.table("lineitem")
    return quality.union_all(
        [
            violations(orders, "orders", order_rules()),
            violations(w.table("customer"), "customer", [non_negative("c_acctbal"), required("c_name")]),
            violations(w.table("supplier"), "supplier", [non_negative("s_acctbal", null_ok=False)]),
            violations(lines, "lineitem", [percentage("l_quantity"), percentage("l_extendedprice")]),
            violations(
                labelled_documents(w),
                "documents",
                [non_negative("quality"), Rule("quality >= 0 strict", "quality >= 0", null_ok=False)],
            ),
        ]
    )


def audit_events(w: StandIn) -> DataFrame:
    """Events read as load audit: views open a run, clicks are single entries, the rest close runs."""
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k").cast("int")
    return w.table("events").select(
        "event_id",
        F.when(kind != "click", F.col("user_id")).alias("log_id"),
        F.concat(F.lit("package_"), (F.col("user_id") % 7).cast("string")).alias("package"),
        kind.alias("task"),
        F.when(kind == "view", audit.RUNNING).when(kind == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(kind == "purchase", number).alias("rows_processed"),
        F.when(kind == "error", F.concat(F.lit("code "), number.cast("string"))).alias("error"),
        F.col("ts").alias("at"),
    )


@query
def audit_latest_state(w: StandIn) -> DataFrame:
    state = audit.audit_state(audit_events(w))
    return state.select(
        "log_id", "lone_event_id", "package", "task", "status", "rows_processed", "error", "duration_s"
    )


# --- aggregates --------------------------------------------------------------------


@query
def indicator_pivot(w: StandIn) -> DataFrame:
    """First order of each year and priority, by order key, as one row per year."""
    long = w.table("orders").select(
        F.year("o_orderdate").alias("Year"),
        F.element_at(F.split("o_orderpriority", "-"), 2).alias("Indicator"),
        F.col("o_totalprice").alias("Value"),
        F.col("o_orderkey").alias("position"),
    )
    names = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"]
    wide = series.pivot_first(long, "Year", "Indicator", "Value", names, ["position"])
    return wide.withColumnRenamed("NOT SPECIFIED", "NOT_SPECIFIED")


@query
def dedup_keep_first(w: StandIn) -> DataFrame:
    lines = w.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return series.keep_first(lines, ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


@query
def dq_completeness(w: StandIn) -> DataFrame:
    orders = w.table("orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return quality.union_all(
        [
            quality.completeness(w.table("lineitem"), "lineitem", ["l_orderkey", "l_shipdate", "l_quantity"]),
            quality.completeness(orders, "orders", ["o_orderkey", "status"]),
            quality.completeness(labelled_documents(w), "documents", ["text", "quality", "toxic"]),
        ]
    )


@query
def dq_uniqueness(w: StandIn) -> DataFrame:
    return quality.union_all(
        [
            quality.uniqueness(w.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
            quality.uniqueness(w.table("orders"), "orders", ["o_orderkey"]),
            quality.uniqueness(w.table("events"), "events", ["user_id", "event_type"]),
            quality.uniqueness(labelled_documents(w), "documents", ["lang", "quality"]),
        ]
    )


@query
def summary_stats(w: StandIn) -> DataFrame:
    """Taken in hundredths, which are whole numbers, and shown in units."""
    priced = w.table("lineitem").select(
        hundredths("l_quantity").alias("quantity"), hundredths("l_extendedprice").alias("price")
    )
    valued = w.table("events").select(hundredths("value").alias("value"))
    found = quality.summary_stats({"lineitem": (priced, ["quantity", "price"]), "events": (valued, ["value"])})
    return found.withColumns({c: F.col(c) / 100 for c in ("min", "max", "mean", "median")})


def gate_findings(w: StandIn) -> DataFrame:
    """All checks of the gate over the yearly tables derived from the given ones."""
    emissions, economy, national, provinces = w.sector_emissions, w.economy, w.national, w.provinces
    coverage = quality.year_coverage(
        {"national": (national, F.col("Year")), "sector": (emissions, F.col("Year")), "economy": (economy, F.col("Year"))}
    )
    positives = [positive(c, null_ok=False) for c in ("GRDP_Billion_VND", "Population", "Estimated_Carbon_Tonnes")]
    return quality.gate_rows(
        profiled=[
            quality.profile(
                national,
                "national",
                ["Year", "CO2_MtCO2e", "Total_GHG_MtCO2e"],
                [non_negative("CO2_MtCO2e"), non_negative("Total_GHG_MtCO2e")],
            ),
            quality.profile(
                emissions,
                "sector",
                ["Year", "Sector_Code", "Gas", "Emissions_MtCO2e"],
                [non_negative("Emissions_MtCO2e")],
            ),
            quality.profile(
                economy,
                "economy",
                ["Year", "Province_Code", "GRDP_Billion_VND", "Population"],
                [*positives, percentage("Forest_Coverage_Pct", null_ok=False)],
            ),
            quality.profile(provinces, "provinces", ["Province_Code", "Province_Name", "Region", "Area_Km2"]),
        ],
        consistent=[quality.year_consistency(coverage, standin.COMMON_YEARS)],
        referential=[quality.reference_counts(economy, "Province_Code", provinces, "Province_Code", 25)],
        unique=[
            quality.uniqueness(national, "national", ["Year"]),
            quality.uniqueness(emissions, "sector", ["Year", "Sector_Code", "Gas"]),
            quality.uniqueness(economy, "economy", ["Year", "Province_Code"]),
            quality.uniqueness(provinces, "provinces", ["Province_Code"]),
        ],
        counted=[quality.row_count(provinces, "provinces", k.PROVINCE_COUNT)],
    )


@query
def dq_gate(w: StandIn) -> DataFrame:
    return quality.gate(gate_findings(w))


@query
def sector_rollup(w: StandIn) -> DataFrame:
    """Totals per scope, category and sector and above, without the total row."""
    rows = w.national_view.where(F.col("Sector_Code") != k.TOTAL_SECTOR)
    return rows.rollup("Scope_Type", "Sector_Category", "Sector_Name_VI").agg(
        F.grouping_id().cast("long").alias("level"), F.sum("Emissions_MtCO2e").alias("Emissions")
    )


# --- yearly series -------------------------------------------------------------------


def customer_years(w: StandIn) -> DataFrame:
    return w.table("orders").groupBy("o_custkey", F.year("o_orderdate").alias("Year")).agg(
        amount(F.sum(hundredths("o_totalprice"))).alias("spent")
    )


@query
def yoy_growth(w: StandIn) -> DataFrame:
    """Per customer and year; years without orders after one with orders are -100 %."""
    lagged = series.with_lags(customer_years(w), ["o_custkey"], "Year", "spent", [1], k.LAST_YEAR)
    return lagged.withColumn("growth", F.round(ratios.growth(F.col("spent"), F.col("spent_minus_1")), 6))


@query
def cagr_5y(w: StandIn) -> DataFrame:
    lagged = series.with_lags(customer_years(w), ["o_custkey"], "Year", "spent", [5], k.LAST_YEAR)
    rate = ratios.cagr(F.col("spent"), F.col("spent_minus_5"), k.CAGR_YEARS)
    return lagged.where(F.col("spent").isNotNull()).withColumn("cagr", F.round(rate, 6))


# --- nested inputs -------------------------------------------------------------------


@query
def json_series_explode(w: StandIn) -> DataFrame:
    """Indicator payloads of every customer, parsed back; a payload holds at most one point per year."""
    yearly = w.table("orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("code")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    point = F.struct(
        F.when(F.col("y") == 2001, F.lit("2001-08")).otherwise(F.col("y").cast("string")).alias("date"),
        F.when(F.col("v") >= 100000, F.col("v")).alias("value"),
    )
    lists = yearly.groupBy("o_custkey", "code").agg(F.sort_array(F.collect_list(point)).alias("points"))
    payload = F.to_json(
        F.map_from_entries(F.array(F.struct("code", "points"))), {"ignoreNullFields": "false"}
    )
    parsed = payloads.indicator_rows(
        lists.select("o_custkey", payload.alias("payload")),
        indicators={"1-URGENT": "CO2", "2-HIGH": "GDP", "3-MEDIUM": "Methane"},
        keep=("o_custkey",),
        type_="map<string, array<struct<date: string, value: decimal(18,2)>>>",
    )
    return parsed.drop("position")


@query
def sector_series_parse(w: StandIn) -> DataFrame:
    """Sector payloads of every part type, flag and source: parsed, mapped, first per (year, code, gas)."""
    yearly = (
        w.table("lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").alias("y"), "l_returnflag", "l_linestatus")
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
        .join(w.table("part").select("p_partkey", "p_type"), "p_partkey")
        .groupBy("p_type", "l_returnflag", "l_linestatus", "y")
        .agg(F.sum("v").alias("v"))
    )
    point = F.struct(F.col("y").alias("year"), F.col("v").alias("value"))
    item = yearly.groupBy("p_type", "l_returnflag", "l_linestatus").agg(
        F.sort_array(F.collect_list(point)).alias("emissions")
    )
    gas = F.when(F.col("l_returnflag") == "N", "All GHG").when(F.col("l_returnflag") == "A", "CO2").otherwise("N2O")
    entry = F.struct(F.col("p_type").alias("sector"), gas.alias("gas"), F.col("l_linestatus").alias("source"), "emissions")
    payload = item.select("p_type", F.to_json(F.struct(F.array(entry).alias("data"))).alias("payload"))
    type_ = payloads.SECTOR_PAYLOAD.replace("double", "decimal(18,2)")
    rows = payloads.map_sectors(payloads.sector_rows(payload, type_=type_), mapping=STANDIN_SECTOR_MAP)
    first = series.keep_first(rows, ["Year", "Sector_Code", "Gas"], ["Source", "Sector_Raw", "item_pos", "point_pos"])
    return first.select("Year", "Sector_Code", "Sector_Name_EN", "Sector_Category", "Gas", "Source", "Emissions_MtCO2e")


# --- names and maps --------------------------------------------------------------------


@query
def name_key_join(w: StandIn) -> DataFrame:
    """Part names with marks, capitals and dashes matched to the plain name list."""
    marked = F.translate(F.upper("p_name"), "AEIOUD ", "ẠẾĨÔŨĐ-")
    raw = w.table("part").groupBy(F.concat(F.lit("TP. "), marked).alias("raw_name")).agg(
        F.count(F.lit(1)).alias("Parts")
    )
    master = w.table("part").select(F.col("p_name").alias("name")).distinct()
    matched = geography.require_match(geography.match_names(raw, "raw_name", master, "name"), "raw_name", "name")
    return matched.select("raw_name", "match_key", "name", "Parts")


@query
def text_keys(w: StandIn) -> DataFrame:
    """Name keys of whole documents in four languages."""
    key = name_key(F.col("text"))
    return w.table("documents").select("doc_id", F.length(key).cast("long").alias("key_chars"), F.md5(key).alias("key_md5"))


@query
def feature_types(w: StandIn) -> DataFrame:
    """Embeddings as pieces of places, matched by a differently spelt name and typed per place."""
    label = F.col("label")
    pieces = w.table("embeddings").select(
        F.concat(F.lit("Ñation–"), (label * 2).cast("string"), F.lit("\t")).alias("shape_name"),
        F.when(F.size("embedding") > 0, F.array(F.array("vec_id"))).alias("ring_sets"),
    )
    matched = geography.match_names(pieces, "shape_name", w.provinces, "Province_Name")
    return geography.feature_types(
        geography.require_match(matched, "shape_name", "Province_Code"), "Province_Code", "ring_sets"
    )


@query
def nonempty_rows(w: StandIn) -> DataFrame:
    """Largest urgent and low order per customer, without customers that have neither."""
    wide = w.table("orders").groupBy("o_custkey").agg(
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))).alias("urgent"),
        F.max(F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice"))).alias("low"),
    )
    return series.nonempty_rows(wide, ["urgent", "low"])


def vector_arcs(w: StandIn) -> DataFrame:
    """Embeddings as delta-coded arcs: pairs of components are integer steps."""

    def step(i):
        return F.floor(F.get("embedding", i).cast("double") * 10000)

    first = F.sequence(F.lit(0), F.floor(F.size("embedding") / 2).cast("int") - 1)
    pairs = F.transform(first, lambda i: F.array(step(i * 2), step(i * 2 + 1)))
    return w.table("embeddings").select("vec_id", "label", pairs.alias("deltas"))


@query
def delta_decode_bbox(w: StandIn) -> DataFrame:
    """Extent of each decoded arc, folded inside its row."""
    return vector_arcs(w).select("vec_id", geography.arc_extent(F.col("deltas")).alias("e")).select(
        "vec_id", "e.min_x", "e.min_y", "e.max_x", "e.max_y"
    )


@query
def map_bounding_box(w: StandIn) -> DataFrame:
    scale, shift = (F.lit(0.0001), F.lit(0.0002)), (F.lit(102.0), F.lit(8.0))
    return geography.bounding_box(vector_arcs(w), "deltas", scale, shift)


@query
def delta_running_points(w: StandIn) -> DataFrame:
    """Every decoded point, by running sums over rows."""
    points = vector_arcs(w).select("vec_id", F.posexplode("deltas").alias("pos", "d")).select(
        "vec_id", "pos", F.col("d")[0].alias("dx"), F.col("d")[1].alias("dy")
    )
    return series.running_sums(points, ["vec_id"], "pos", ["dx", "dy"], block=8)


@query
def map_gate(w: StandIn) -> DataFrame:
    """Embeddings as features named by their label, checked against the province list."""
    features = vector_arcs(w).select(
        standin.province_code(F.col("label") + 5).alias("Province_Code"),
        F.concat(F.lit("NATION_"), (F.col("label") + 5).cast("string")).alias("Province_Name"),
        F.array(F.array("deltas")).alias("ring_sets"),
    )
    box = geography.bounding_box(vector_arcs(w), "deltas", (F.lit(0.0001), F.lit(0.0002)), (F.lit(102.0), F.lit(8.0)))
    master = w.provinces.select("Province_Code", "Province_Name")
    return geography.map_gate(features, box, master, "Province_Code", "Province_Name")


# --- air, allocation and population -----------------------------------------------------


@query
def aqi_index(w: StandIn) -> DataFrame:
    return w.readings.select("event_id", "AQI_Index", "Is_Exceeding_QCVN")


@query
def aqi_category_hours(w: StandIn) -> DataFrame:
    return w.readings.groupBy("Station_Code", "AQI_Category").agg(
        F.count(F.lit(1)).alias("Hours"), F.count_if("Is_Exceeding_QCVN").alias("Exceeding")
    )


@query
def allocate_by_share(w: StandIn) -> DataFrame:
    """Yearly order totals allocated to nations by their share of customers; 2002 has no total."""
    people = w.table("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n").cast("double") / people.agg(F.sum("n")).scalar()
    catalog = people.select(
        standin.province_code(F.col("c_nationkey")).alias("Province_Code"),
        share.alias("share"),
        (F.col("c_nationkey") % 2 == 0).alias("hub"),
    )
    price = F.sum(money("o_totalprice")).cast("double")
    national = w.table("orders").groupBy(F.year("o_orderdate").alias("Year")).agg(
        price.alias("GRDP"), (F.count(F.lit(1)) / 1000.0).alias("GHG")
    )
    # every year of the data, and the one after for the rule of missing years
    first = national.agg(F.min("Year").alias("first")).scalar()
    last = national.agg((F.max("Year") + 1).alias("last")).scalar()
    spread = allocation.allocate_by_share(
        allocation.with_years(catalog, first, last), national, "share", F.col("hub")
    )
    return spread.drop("share", "hub")


@query
def population_projection(w: StandIn) -> DataFrame:
    """Nations with a supplier of negative balance have a base; the others start from their area."""
    base = (
        w.table("supplier")
        .where(F.col("s_acctbal") < 0)
        .groupBy(standin.province_code(F.col("s_nationkey")).alias("Province_Code"))
        .agg((F.count(F.lit(1)) * 1000).alias("base_thousands"))
    )
    years = allocation.with_years(w.provinces.select("Province_Code", "Area_Km2"), 2015, 2024)
    return allocation.project_population(years, base, "Province_Code", F.col("Area_Km2"), F.col("Year")).select(
        "Year", "Province_Code", "Population"
    )


# --- measures ------------------------------------------------------------------------------


@query
def measures_national_by_year(w: StandIn) -> DataFrame:
    rows = measures.national_by_year(w.national_view, w.dates, baseline_year=standin.BASELINE_YEAR)
    return rows.withColumn("Emissions_CAGR_5Y", F.round("Emissions_CAGR_5Y", 6))


@query
def measures_national_by_sector(w: StandIn) -> DataFrame:
    """The same measures per sector, each sector against its own baseline."""
    rows = measures.national_by_year(w.national_view, w.dates, ["Sector_Code"], standin.BASELINE_YEAR)
    return rows.select(
        "Year",
        "Sector_Code",
        "Total_GHG_Emissions",
        "National_GDP",
        "National_Emission_Intensity",
        "Emissions_Prior_Year",
        "Emissions_YoY_Growth",
        F.round("Emissions_CAGR_5Y", 6).alias("Emissions_CAGR_5Y"),
        "Target_Gap",
    )


@query
def measures_guarded(w: StandIn) -> DataFrame:
    return measures.guarded(w.national_view, ["Year"], standin.GAS)


def target(w: StandIn):
    return measures.baseline_target(w.national_view, standin.BASELINE_YEAR)


@query
def measures_provincial(w: StandIn) -> DataFrame:
    return measures.provincial_by_year(w.provincial_view, w.provinces, w.dates, target(w))


@query
def measures_provincial_by_region(w: StandIn) -> DataFrame:
    """At region grain the area is summed over the provinces of the dimension."""
    rows = measures.provincial_by_year(w.provincial_view, w.provinces, w.dates, target(w), ["Region"])
    return rows.select("Year", "Region", "Provincial_GRDP", "Carbon_Density", "GRDP_YoY_Growth", "Quota_Realization")


@query
def measures_air(w: StandIn) -> DataFrame:
    return w.air_measures(["Province_Code", "Station_Type"])


@query
def measures_air_total(w: StandIn) -> DataFrame:
    """The four-table join aggregate over the whole hourly fact."""
    return w.air_measures(["Region", "Time_Bucket"])


@query
def provincial_narrative(w: StandIn) -> DataFrame:
    return measures.provincial_narrative(w.provincial_view, w.air_measures(["Province_Code"]), w.provinces, target(w))


@query
def card_title(w: StandIn) -> DataFrame:
    """Card title per zone and region of the province dimension: one province is named, several are the whole country."""
    chosen = measures.selected_value("Province_Name", k.NO_SELECTION)
    return w.provinces.groupBy("Economic_Zone", "Region").agg(measures.card_title(chosen).alias("Card_Title"))


@query
def measures_air_by_rush(w: StandIn) -> DataFrame:
    """By rush hour the rush-hour measure keeps its own filter: the same value on both rows of a region."""
    return w.air_measures(["Region", "Is_Rush_Hour"])


NATIONAL_MEASURES = ["Total_GHG_Emissions", "Total_CO2_Emissions", "National_GDP", "National_Emission_Intensity"]


@query
def measures_by_decade(w: StandIn) -> DataFrame:
    """Base measures by decade and sector: GDP and intensity are those of the decade's total rows."""
    return measures.measure(w.national_view, NATIONAL_MEASURES, ["Decade", "Sector_Code"])


@query
def measures_total(w: StandIn) -> DataFrame:
    """Base measures of all years and sectors together."""
    return measures.measure(w.national_view, NATIONAL_MEASURES)


# --- dashboard data --------------------------------------------------------------------------


@query
def dashboard_gdp_co2(w: StandIn) -> DataFrame:
    return measures.measure(
        w.national_view, ["National_GDP", "Total_CO2_Emissions", "National_Emission_Intensity"], ["Year"]
    )


@query
def dashboard_sector_share(w: StandIn) -> DataFrame:
    rows = w.national_view.where(F.col("Sector_Code") != k.TOTAL_SECTOR)
    sums = rows.groupBy("Year", "Sector_Code").agg(F.sum("Emissions_MtCO2e").alias("Total_GHG_Emissions"))
    return share_within(sums, "Total_GHG_Emissions", ["Year"], "Share")


# --- named variants ----------------------------------------------------------------------------


@query
def tapio_elasticity(w: StandIn) -> DataFrame:
    return variants.tapio_elasticity(w.provincial_view, ["Province_Code"])


@query
def pm25_daily_limit(w: StandIn) -> DataFrame:
    return variants.daily_limit(w.readings)


def ring_map(w: StandIn) -> DataFrame:
    """A map in text for every label: each vector is a ring of two arcs that share both ends, the second walked backwards."""
    vectors = vector_arcs(w).where(F.size("deltas") > 1)
    ends = F.aggregate("deltas", F.array(F.lit(0).cast("long"), F.lit(0).cast("long")), lambda at, d: F.array(at[0] + d[0], at[1] + d[1]))
    vectors = vectors.withColumn("a", F.col("deltas")[0]).withColumn("z", ends)
    x, y = (F.col("z")[i] - F.col("a")[i] - s for i, s in ((0, 7), (1, -3)))
    other = F.array("a", F.array(F.lit(7).cast("long"), F.lit(-3).cast("long")), F.array(x, y))
    one = F.struct("vec_id", "deltas", other.alias("other"))
    maps = vectors.groupBy("label").agg(F.sort_array(F.collect_list(one)).alias("v"))
    shape = F.transform(
        "v",
        lambda v, i: F.struct(
            F.lit("Polygon").alias("type"),
            v.vec_id.cast("string").alias("id"),
            F.array(F.array(i * 2, -(i * 2) - 2)).alias("arcs"),
            F.create_map(F.lit("name"), F.concat(F.lit("Ñation–"), (F.col("label") * 2).cast("string"), F.lit("\t"))).alias("properties"),
        ),
    )
    whole = F.struct(
        F.lit("Topology").alias("type"),
        F.create_map(F.lit("raw"), F.struct(F.lit("GeometryCollection").alias("type"), shape.alias("geometries"))).alias("objects"),
        F.flatten(F.transform("v", lambda v: F.array(v.deltas, v.other))).alias("arcs"),
    )
    return maps.select(F.concat(F.lit("map-"), F.col("label").cast("string")).alias("file"), F.to_json(whole).alias("value"))


@query
def stitched_features(w: StandIn) -> DataFrame:
    """From topology text to grouped, enriched features with closed rings: arcs decoded, rings stitched, names matched."""
    maps = ring_map(w).select("file", F.from_json("value", topology.TOPOLOGY).alias("topology"))
    shapes, arcs = topology.geometries(maps), topology.arcs(maps)
    points = rings.ring_points(shapes, arcs)
    matched = geography.match_names(shapes.withColumn("name", F.col("properties")["name"]), "name", w.provinces, "Province_Name")
    matched = geography.require_match(matched, "name", "Province_Code")
    places = rings.place_summary(rings.ring_summary(points), matched, "Province_Code")
    walked = points.join(matched.select(*rings.FEATURE, "Province_Code"), list(rings.FEATURE)).groupBy("Province_Code").agg(
        F.sum(F.col("place") * F.col("x")).alias("walk_x"), F.sum(F.col("place") * F.col("y")).alias("walk_y")
    )
    return places.join(walked, "Province_Code").join(w.provinces.select("Province_Code", "Province_Name", "Region"), "Province_Code")


@query
def plan_phase_by_bands(w: StandIn) -> DataFrame:
    """Plan phases from a table of bands, without a join by range."""
    ends = [upper for upper, _ in k.PLAN_PHASES]
    rows = zip([None, *(e + 1 for e in ends)], [*ends, None], [*(text for _, text in k.PLAN_PHASES), k.PLAN_PHASE_AFTER])
    table = F.array(*(F.struct(F.lit(a).cast("int").alias("lower"), F.lit(b).cast("int").alias("upper"), F.lit(c).alias("label")) for a, b, c in rows))
    phases = w.spark.range(1).select(F.inline(table))
    orders = w.table("orders").select(F.year("o_orderdate").alias("Year"), money("o_totalprice").alias("price"))
    found = bands.by_band_table(orders, F.col("Year"), phases, "Five_Year_Plan_Phase")
    return found.groupBy("Five_Year_Plan_Phase", cal.policy_period(F.col("Year")).alias("Policy_Period")).agg(
        F.count(F.lit(1)).alias("Orders"), F.sum("price").alias("Total")
    )


# --- written tables -----------------------------------------------------------------


@writing_query
def hourly_stream_upsert(w: StandIn) -> DataFrame:
    """The hourly fact from a stream that delivers every reading twice; half of them are older than the watermark."""
    path = scratch(w.spark, "stream")
    # a pattern, as a stream takes a single file by pattern only
    events = w.spark.readStream.schema(standin.TABLES["events"]).parquet(f"{w.sf_dir}/event[s].parquet")
    readings = w.readings_of(events).withColumn("Arrived_At", F.lit("2024-02-01").cast("timestamp"))

    def to_fact(batch: DataFrame) -> DataFrame:
        keep = ("Month", "Day", "Arrived_At")
        return facts.hourly_fact(batch, w.dates, w.hours, w.provinces, w.stations, row_id=F.col("event_id"), keep=keep)

    feed = hourly_feed.load_fact(
        readings.unionByName(readings), to_fact, f"{path}/fact", f"{path}/checkpoint", now=F.lit("2024-01-31").cast("timestamp"), delay="15 days"
    )
    feed.awaitTermination()
    return snapshots.read(w.spark, f"{path}/fact").select(*w.hourly_fact.columns)


@writing_query
def snapshot_reload(w: StandIn) -> DataFrame:
    """Orders by year as a fact in snapshots, then the years replaced as staged (odd ones lose all rows), each load in one step."""
    path = scratch(w.spark, "fact")
    loaded = w.table("orders").select(F.year("o_orderdate").alias("Date_Key"), F.lit("loaded").alias("origin"))
    staged = shipped_since(w, 1996).select(F.year("l_shipdate").alias("Date_Key"), F.lit("staged").alias("origin"))
    for rows, years in ((loaded, loaded), (staged.where(F.col("Date_Key") % 2 == 0), staged)):
        snapshots.replace(rows, path, ["Date_Key"], snapshots.staged_slices(years, ["Date_Key"]))
    versions = [snapshots.read(w.spark, path, v).withColumn("Version", F.lit(v)) for v in (1, 2)]
    return quality.union_all(versions).groupBy("Version", "Date_Key", "origin").agg(F.count(F.lit(1)).alias("Fact_Rows"))


@writing_query
def clustered_station_days(w: StandIn) -> DataFrame:
    """Days of a few stations out of the hourly fact, clustered by station and day with Bloom filters."""
    path = scratch(w.spark, "fact")
    last = w.stations.agg(F.max("Station_Key").alias("last")).first()["last"] or 1
    layout = snapshots.Layout((("Station_Key", 1, last), ("Day", 1, 31)), bloom=("Station_Key",), bloom_values=last, row_group=1 << 20)
    months = snapshots.staged_slices(w.readings, hourly_feed.MONTHS)
    snapshots.replace(w.hourly_fact, path, hourly_feed.MONTHS, months, key="Monitoring_ID", layout=layout)
    found = snapshots.read(w.spark, path).where("Station_Key IN (3, 7, 11) AND Month = 1 AND Day BETWEEN 5 AND 9")
    return found.groupBy("Station_Key", "Day").agg(F.count(F.lit(1)).alias("Readings"), F.sum("PM25_ug_m3").alias("PM25"))


LINE_SPEC = profiles.Spec(
    "lineitem",
    ("l_orderkey", "l_returnflag", "l_quantity", "l_extendedprice"),
    ("l_quantity", "l_extendedprice"),
    (positive("l_quantity"), non_negative("l_discount")),
    ("Date_Key", "l_orderkey", "l_linenumber"),
)


@writing_query
def incremental_profile(w: StandIn) -> DataFrame:
    """Line items by shipping year, profiled; the year 1996 reloaded without its returned lines, and only that year profiled again."""
    path = scratch(w.spark, "lines")
    lines = w.table("lineitem").withColumn("Date_Key", F.year("l_shipdate"))
    refreshed = []
    for rows in (lines, lines.where("Date_Key = 1996 AND l_returnflag <> 'R'")):
        snapshots.replace(rows, f"{path}/fact", ["Date_Key"], snapshots.staged_slices(rows, ["Date_Key"]))
        refreshed.append(len(profiles.refresh(w.spark, f"{path}/fact", f"{path}/profiles", LINE_SPEC)))
    found = profiles.merged(w.spark, f"{path}/fact", f"{path}/profiles", LINE_SPEC)
    exact = ("column", "rows", "nulls", "min", "max")
    return found.select(*exact, F.round("mean", 6).alias("mean"), F.lit(refreshed[1]).alias("slices_profiled_again"))


@query
def measures_air_grains(w: StandIn) -> DataFrame:
    """Air measures at three grains out of one scan."""
    grains = (("Province_Code", "Station_Type"), ("Region", "Time_Bucket"), ("Region", "Is_Rush_Hour"))
    rows = cuboids.star_rows(w.hourly_fact, w.dates, w.hours, w.provinces, w.stations)
    return cuboids.measures_of(cuboids.sums_at(rows, grains))


@writing_query
def bucketed_merge(w: StandIn) -> DataFrame:
    """The same merge on a target in buckets, which is neither shuffled nor broadcast."""
    path = scratch(w.spark, "members")
    target, source = merge_sides(w)
    buckets = int(w.spark.conf.get("spark.sql.shuffle.partitions"))
    lying = bucketed.create(target, "members_" + path.rsplit("-", 1)[-1], path, "Member_Code", buckets)
    return bucketed.merged(lying, source, "Member_Code", MERGED, "Member_Key", **MERGE_OPTIONS)


@writing_query
def landed_payload_fields(w: StandIn) -> DataFrame:
    """Orders landed as JSON records in two deliveries: the later one has a field more, and its amount has become text."""
    path = scratch(w.spark, "landed")
    orders = w.table("orders")
    amount_ = F.col("o_totalprice").cast("decimal(18,2)")
    known = (F.col("o_orderkey").alias("id"), F.struct(F.year("o_orderdate").alias("year")).alias("at"))
    first = F.struct(*known, amount_.alias("value"))
    later = F.struct(*known, amount_.cast("string").alias("value"), F.col("o_orderpriority").alias("priority"))
    for rows, record in ((orders.where("o_orderkey % 2 = 0"), first), (orders.where("o_orderkey % 2 = 1"), later)):
        payloads.land_records(rows.select(F.to_json(record).alias("record")), path)
    fields = {"Year": ("$.at.year", "int"), "Value": ("$.value", "decimal(18,2)"), "Priority": ("$.priority", "string")}
    found = payloads.landed_fields(w.spark, path, fields)
    return found.groupBy("Year", "Priority").agg(F.count(F.lit(1)).alias("Records"), F.sum("Value").alias("Total"))


@writing_query
def csv_round_trip(w: StandIn) -> DataFrame:
    """Customers written as CSV, with names that need quoting, and read back by header name."""
    path = scratch(w.spark, "csv")
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit('", '), F.col("c_custkey").cast("string"))
    rows = w.table("customer").select(F.col("c_custkey").alias("Row"), name.alias("Name"), F.when(F.col("c_acctbal") >= 0, F.rint(F.col("c_acctbal") * 100).cast("long")).alias("Cents"), F.concat(F.lit(" c"), F.col("c_nationkey").cast("string")).alias("Nation_Code"))
    csvfiles.write_csv(rows, path)
    return csvfiles.read_csv(w.spark, path, "Nation_Code string, Row bigint, Name string, Cents bigint", {"Cents": 0})


@writing_query
def payload_round_trip(w: StandIn) -> DataFrame:
    """Raw payloads of every order priority landed as text and parsed from there."""
    path = scratch(w.spark, "payloads")
    point = F.struct(F.year("o_orderdate").cast("string").alias("date"), F.col("o_orderkey").alias("value"))
    lists = w.table("orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(point)).alias("points"))
    payloads.land_payload(lists.select(F.to_json(F.struct(F.col("o_custkey").alias("customer"), "points")).alias("payload")), path)
    landed = w.spark.read.text(path).select(F.from_json("value", "struct<customer: bigint, points: array<struct<date: string, value: bigint>>>").alias("p"))
    rows = landed.select("p.customer", F.inline("p.points"))
    return rows.groupBy(F.col("date").cast("int").alias("Year")).agg(F.count(F.lit(1)).alias("Points"), F.countDistinct("customer").alias("Customers"), F.sum("value").alias("Total"))


@writing_query
def staged_reload(w: StandIn) -> DataFrame:
    """A staging table overwritten by a second file, truncated, and staged again: the last rows and their lineage stay."""
    path = scratch(w.spark, "staging")
    rows = w.table("orders").select("o_orderkey", "o_orderpriority")
    tables.stage_overwrite(rows, path, "first.csv")
    tables.stage_overwrite(rows.where("o_orderkey % 2 = 0"), path, "second.csv")
    kept = w.spark.read.parquet(path).count()
    tables.truncate(w.spark, path)
    emptied = w.spark.read.parquet(path).count()
    tables.stage_overwrite(rows.where("o_orderkey % 3 = 0"), path, "third.csv")
    found = w.spark.read.parquet(path).where("Loaded_At IS NOT NULL").groupBy("Source_File").agg(F.count(F.lit(1)).alias("Staged"))
    return found.select("Source_File", "Staged", F.lit(kept).alias("Second"), F.lit(emptied).alias("Truncated"))


@query
def enriched_features(w: StandIn) -> DataFrame:
    """Embeddings as pieces of places: grouped in their order, typed, and enriched with the province's attributes."""
    label = F.col("label")
    pieces = w.table("embeddings").select(
        "vec_id", F.concat(F.lit("Ñation–"), (label * 2).cast("string")).alias("shape_name"), F.array(F.array("vec_id")).alias("ring_sets")
    )
    matched = geography.require_match(geography.match_names(pieces, "shape_name", w.provinces, "Province_Name"), "shape_name", "Province_Code")
    grouped = geography.group_features(matched, "Province_Code", "ring_sets", "vec_id")
    found = geography.enrich_features(grouped, w.provinces, "Province_Code", ["Province_Name", "Region", "Economic_Zone"])
    rings_ = F.array_join(F.transform(F.flatten("ring_sets"), lambda arc: arc.cast("string")), ",")
    return found.select("Province_Code", "type", F.md5(rings_).alias("rings_md5"), "properties.id", "properties.Province_Name", "properties.Region", "properties.Economic_Zone")


@query
def catalog_columns(w: StandIn) -> DataFrame:
    """The dimension part of an allocation catalog under its own names."""
    names = {v: n for n, v in allocation.CATALOG_NAMES.items()}
    catalog = w.provinces.select(*(F.col(c).alias(names[c]) for c in names), F.lit(0.5).alias("grdp_share"))
    return allocation.catalog_dimension(catalog)


@query
def seeded_sectors(w: StandIn) -> DataFrame:
    """The seeded sectors merged with what staging brings: codes by order priority, two of them known; a NULL name keeps nothing."""
    codes = {"1-URGENT": "ENG", "2-HIGH": "TRA", "3-MEDIUM": "IPU", "4-NOT SPECIFIED": "WST", "5-LOW": "ZZZ"}
    code = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))[F.col("o_orderpriority")]
    names = w.table("orders").groupBy(code.alias("Sector_Code")).agg(F.min("o_orderpriority").alias("Sector_Name_EN"), F.count(F.lit(1)).cast("string").alias("Sector_Name_VI"))
    source = names.where(F.col("Sector_Code").isNotNull()).withColumn("Sector_Category", F.lit("Staged"))
    seeded = dense_keys(generators.sector_seed(w.spark), "Sector_Code", "Sector_Key")
    merged = merge.scd1_merge(seeded, source, "Sector_Code", SECTOR_COLUMNS, "Sector_Key")
    return merged.where("Sector_Category = 'Staged'").drop("Sector_Key")
