"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

"queries" run to their last row into a sink that keeps nothing, one after the other in one session,
as a report would: plans and the small yearly tables are shared, so the first query over a yearly
table pays for it. "cold" times each of them again with everything dropped before. Three
untimed queries over the smallest tables warm the JVM up; each query is timed once, or BENCH_RUNS times with the best counted.

"loaded" is the warehouse itself: a year of generated hourly readings (189 stations, 8,784 hours) as
a bulk file, its load into staging and into the fact, and the four-table join aggregate over the
loaded fact, from the star and from stored sums. Set BENCH_LOADED=0 to leave it out.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from carbonloom.plans import measures  # noqa: E402
from carbonloom.plans.jobs import Warehouse  # noqa: E402
from carbonloom.plans.standin import stand_in  # noqa: E402
from carbonloom.queries import QUERIES  # noqa: E402
from carbonloom.session import local_session, work_dir  # noqa: E402

HEADLINE = [
    "measures_air_total",
    "hourly_fact",
    "vw_fact_hourly",
    "measures_air",
    "aqi_category_hours",
    "top_emitters_latest_year",
    "decade_trend",
    "sector_share_by_phase",
    "quadrant_matrix",
    "national_fact",
    "provincial_fact",
    "measures_national_by_year",
    "measures_provincial",
    "provincial_narrative",
    "yoy_growth",
    "cagr_5y",
    "dedup_keep_first",
    "scd1_merge",
    "idempotent_reload",
    "sector_rollup",
    "dq_completeness",
    "dq_uniqueness",
    "constraint_violations",
    "summary_stats",
    "dq_gate",
    "json_series_explode",
    "name_key_join",
    "text_keys",
    "delta_decode_bbox",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def folder(spark) -> str:
    """$BENCH_WORK_DIR or the session's shared folder; the machine's own temporary folder only in local mode."""
    given = os.environ.get("BENCH_WORK_DIR") or work_dir(spark, "")
    if not given and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set BENCH_WORK_DIR or spark.checkpoint.dir")
    return given or tempfile.gettempdir()


def loaded(spark) -> dict[str, float]:
    """Bulk file -> staging -> fact -> star-join aggregate, at the size of a full year."""
    root = f"{folder(spark)}/bench-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, f"{root}/warehouse")
    province = F.lpad(F.col("id").cast("string"), 2, "0")
    places = spark.range(1, 64).select(
        province.alias("Province_Code"),
        F.concat(F.lit("Province "), province).alias("Province_Name"),
        F.concat(F.lit("Province "), province).alias("Province_Name_Ascii"),
        F.concat(F.lit("Region "), (F.col("id") % 6).cast("string")).alias("Region"),
        F.lit("Zone").alias("Economic_Zone"),
        F.lit(1000).cast("decimal(10,2)").alias("Area_Km2"),
        (F.col("id") % 2 == 0).alias("Is_Industrial_Hub"),
    )
    warehouse.stage("provinces", places, "generated")
    stations = places.select(
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"), "Province_Code", "Province_Name"
    ).select(
        F.concat(F.lit("ST-"), "Province_Code", F.lit("-0"), F.col("n").cast("string")).alias("Station_Code"),
        F.concat(F.lit("Station "), "Province_Code", F.col("n").cast("string")).alias("Station_Name"),
        "Province_Code",
        "Province_Name",
        F.concat(F.lit("Type "), F.col("n").cast("string")).alias("Station_Type"),
        F.lit(16).cast("decimal(9,6)").alias("Latitude"),
        F.lit(107).cast("decimal(9,6)").alias("Longitude"),
        F.lit(True).alias("Is_Active"),
    )
    warehouse.stage("stations", stations, "generated")
    warehouse.seed_dimensions()
    warehouse.load_stations()

    hour = F.timestamp_add("HOUR", F.col("id") % 8784, F.lit("2024-01-01").cast("timestamp_ntz"))
    station = F.floor(F.col("id") / 8784)
    code = F.lpad((F.floor(station / 3) + 1).cast("string"), 2, "0")
    noise = F.pmod(F.xxhash64("id"), F.lit(6000)) / 100.0
    cells = [
        F.lit("2024"), F.lit("2024"), F.month("at"), F.dayofmonth("at"), F.hour("at"),
        F.concat(F.lit("ST-"), code, F.lit("-0"), (station % 3 + 1).cast("string")), code,
        F.lit("450.25"), F.lit("1.10"), F.lit("20.00"), F.lit("12.00"), F.col("pm"), F.lit("60.00"),
        F.rint(F.col("pm") * 2.2 + 8).cast("int"), F.lit("Tốt"), (F.col("pm") > 50).cast("int"),
    ]
    lines = spark.range(0, 189 * 8784, numPartitions=8).withColumn("at", hour).withColumn("pm", noise)
    lines.select(F.concat_ws(",", *cells).alias("value")).write.text(f"{root}/bulk")

    rows = 189 * 8784
    stage = seconds(lambda: warehouse.stage_hourly(f"{root}/bulk"))
    load = seconds(warehouse.load_hourly_fact)

    def aggregate() -> None:
        assert len(warehouse.air_measures(["Region", "Time_Bucket"]).collect()) == 30

    def aggregate_view() -> None:
        view = warehouse.view("vw_fact_hourly")
        assert len(measures.measure(view, list(measures.AIR), by=["Region", "Time_Bucket"]).collect()) == 30

    def station_month() -> None:
        fact = warehouse.read("fact_hourly").where("Station_Key = 7 AND Month = 3")
        assert fact.count() == 744

    one_station = min(seconds(station_month) for _ in range(3))
    first = seconds(aggregate)
    again = min(seconds(aggregate) for _ in range(3))
    over_view = min(seconds(aggregate_view) for _ in range(3))
    assert warehouse.read("fact_hourly").count() == rows
    # the same aggregate once its sums are stored, and the time to store three grains
    grains = [("Region", "Time_Bucket"), ("Region", "Is_Rush_Hour"), ("Province_Code", "Station_Type", "Time_Bucket")]
    store = seconds(lambda: warehouse.store_air_sums(grains))
    from_sums = min(seconds(aggregate) for _ in range(3))
    return {
        "rows": rows,
        "stage_sec": round(stage, 3),
        "stage_rows_per_sec": round(rows / stage),
        "fact_load_sec": round(load, 3),
        "fact_load_rows_per_sec": round(rows / load),
        "star_join_first_sec": round(first, 3),
        "star_join_sec": round(again, 3),
        "star_join_over_view_sec": round(over_view, 3),
        "store_sums_sec": round(store, 3),
        "star_join_from_sums_sec": round(from_sums, 3),
        "station_month_sec": round(one_station, 3),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench")

    def to_the_end(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def from_nothing(name: str) -> None:
        spark.catalog.clearCache()
        stand_in.cache_clear()
        to_the_end(name)

    for name in ("measures_air_total", "decade_trend", "scd1_merge"):
        QUERIES[name](spark, os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")).collect()
    times = {name: round(min(seconds(lambda: to_the_end(name)) for _ in range(runs)), 3) for name in names}
    cold = {name: round(seconds(lambda: from_nothing(name)), 3) for name in names}
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": spark.sparkContext.defaultParallelism,
        "cold": cold,
    }
    if os.environ.get("BENCH_LOADED", "1") != "0" and not sys.argv[1:]:
        try:
            result["loaded"] = loaded(spark)
        except Exception as error:  # the queries' times still count
            result["loaded"] = {"error": str(error)[:300]}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
