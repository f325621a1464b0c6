"""What every plan must look like: no cross joins, no Python, only needed columns, no late sort of a table."""

import re

import pytest
from pyspark.sql import functions as F

from carbonloom.operators import lookup, merge
from carbonloom.plans.standin import stand_in
from carbonloom.queries import QUERIES, WRITING
from test_oracle import SF_DIR, pytestmark  # noqa: F401

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups", "ExternalRDD")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not [bad for bad in FORBIDDEN if bad in text]
    assert "FileScan" in text


def test_only_needed_columns_are_read(spark):
    text = plan(stand_in(spark, SF_DIR).economy)
    for columns in ("l_orderkey:bigint,l_quantity:double", "c_custkey:bigint,c_nationkey:int"):
        assert f"ReadSchema: struct<{columns}>" in text
    decades = plan(QUERIES["decade_label"](spark, SF_DIR))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", decades) == ["l_quantity:double,l_shipdate:timestamp_ntz"]


def test_filters_reach_the_scan(spark):
    w = stand_in(spark, SF_DIR)
    text = plan(w.hourly_view.where(F.col("Province_Code") == "07").select("Monitoring_ID", "PM25_ug_m3"))
    assert re.search(r"DataFilters: \[[^\]]*lpad", text)


def test_no_job_runs_while_a_plan_is_built(spark):
    """Only queries that write tables, and those of the training-data folder, run jobs before their result is asked for."""
    spark.sparkContext.setJobGroup("plans", "building")
    try:
        for name in QUERIES.keys() - WRITING:
            QUERIES[name](spark, SF_DIR)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_shipping_bound_reaches_the_files(spark):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan(QUERIES["idempotent_reload"](spark, SF_DIR)))


def test_first_rows_are_not_aggregated_by_sorting(spark):
    text = plan(QUERIES["dedup_keep_first"](spark, SF_DIR))
    assert "SortAggregate" not in text and "WindowGroupLimit" in text


def test_medians_take_two_scans_of_each_table(spark):
    df = QUERIES["summary_stats"](spark, SF_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[[^\]]*\].*?/(\w+)\.parquet", final)
    assert scans and max(scans.count(t) for t in scans) <= 2


def test_salts_are_asked_for(spark):
    fact = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert "_salt" not in plan(lookup.spread_lookup(fact, dim, "k", F.col("v")))
    assert "_salt" in plan(lookup.spread_lookup(fact, dim, "k", F.col("v"), salts=4))


def test_reload_broadcasts_the_few_years(spark):
    old = spark.range(1000).select((F.col("id") % 5).alias("y"), "id")
    new = spark.range(10).select((F.col("id") % 2 + 3).alias("y"), "id")
    text = plan(merge.replace_slices(old, new, "y"))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_losses_and_grains_take_one_scan_of_the_fact(spark):
    w = stand_in(spark, SF_DIR)
    dims = {"order": (w.table("orders"), "l_orderkey", "o_orderkey"), "part": (w.table("part"), "l_partkey", "p_partkey")}
    assert plan(lookup.lookup_losses(w.table("lineitem"), dims)).count("/lineitem.parquet") == 1
    text = plan(QUERIES["measures_air_grains"](spark, SF_DIR))
    alone = plan(QUERIES["measures_air"](spark, SF_DIR))
    assert text.count("/events.parquet") == alone.count("/events.parquet") and "Expand" in text
