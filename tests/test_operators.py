"""Joins, merges, reloads, keys, audit and yearly series on small frames with every edge."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from carbonloom.operators import allocation, audit, lookup, merge, ranking, series
from carbonloom.operators.generators import dim_date, dim_time_of_day, sector_seed
from carbonloom.operators.keys import dense_keys, packed_key
from helpers import as_dicts, by_key


def test_generated_dimensions(spark):
    dates = by_key(dim_date(spark), "Year")
    assert len(dates) == 81 and dates[1970]["Decade"] == "1970s" and dates[2050]["Is_Target_Milestone"]
    hours = by_key(dim_time_of_day(spark), "Time_Key")
    assert len(hours) == 24 and hours[6]["Time_Bucket"].startswith("Giờ Cao Điểm Sáng") and not hours[6]["Is_Rush_Hour"]
    assert sector_seed(spark).count() == 9


def test_dense_keys_are_a_numbering(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("code"))
    keys = sorted(r.k for r in dense_keys(df, "code", "k", 10).collect())
    assert keys == list(range(11, 5011))


def test_packed_key(spark):
    df = spark.createDataFrame([(1, 2020), (2, 1)], "a long, b int")
    key = packed_key((F.col("a"), 0), (F.col("b"), 10_000))
    assert [r[0] for r in df.select(key).collect()] == [12020, 20001]
    with pytest.raises(Exception, match="out of bounds"):
        df.select(packed_key((F.col("a"), 0), (F.col("b"), 2000))).collect()


def test_lookups(rows):
    fact = rows("code string, v int", ("a", 1), ("a", 2), ("b", 3), ("x", 4), (None, 5))
    dim = rows("code string, key int", ("a", 1), ("b", 2), ("c", 3))
    expected = [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]
    for salts in (None, 1, 4):
        found = lookup.spread_lookup(fact, dim, "code", F.col("v"), salts=salts)
        assert sorted((r.code, r.v, r.key) for r in found.collect()) == expected
    left = lookup.salted_lookup(fact, dim, "code", F.col("v"), 4, "left")
    assert left.count() == 5
    lost = by_key(lookup.lookup_losses(fact, {"dim": (dim, "code", "code")}), "lookup")
    assert lost["dim"]["rows_lost"] == 2
    sides = {(r.side, r.key) for r in lookup.key_difference(fact, "code", dim, "code").collect()}
    assert sides == {("missing", "x"), ("extra", "c")}


def test_salted_lookup_equals_plain_on_a_hot_key(spark):
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 50).alias("code"), F.col("id").alias("v")
    )
    dim = spark.range(0, 40).select(F.col("id").alias("code"), (F.col("id") * 2).alias("key"))
    plain = hot.join(dim, "code")
    salted = lookup.salted_lookup(hot, dim, "code", F.col("v"), 16)
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


TARGET = "key long, code string, name string, area double, scope string"


def test_scd1_merge(rows):
    target = rows(TARGET, (1, "01", "old", 5.0, "S1"), (7, "02", "kept", 6.0, "S2"))
    source = rows("code string, name string, area double", ("01", "new", None), ("03", "third", None), ("04", "4th", 9.0))
    merged = by_key(
        merge.scd1_merge(
            target, source, "code", ["name", "area"], "key", keep_if_null=["area"], insert_default={"area": 0.0}
        ),
        "code",
    )
    assert merged["01"] == {"key": 1, "code": "01", "name": "new", "area": 5.0, "scope": "S1"}
    assert merged["02"] == {"key": 7, "code": "02", "name": "kept", "area": 6.0, "scope": "S2"}
    assert merged["03"]["area"] == 0.0 and merged["03"]["scope"] is None
    assert merged["04"]["area"] == 9.0
    assert sorted((merged["03"]["key"], merged["04"]["key"])) == [8, 9]


def test_scd1_merge_is_idempotent_and_survives_an_empty_source(rows):
    target = rows(TARGET, (1, "01", "a", 5.0, "S1"))
    source = rows("code string, name string, area double", ("01", "b", 1.0), ("02", "c", 2.0))
    once = merge.scd1_merge(target, source, "code", ["name", "area"], "key")
    twice = merge.scd1_merge(once, source, "code", ["name", "area"], "key")
    assert as_dicts(once, "code") == as_dicts(twice, "code")
    none = merge.scd1_merge(once, source.where("false"), "code", ["name", "area"], "key")
    assert as_dicts(none, "code") == as_dicts(once, "code")


def test_scd1_merge_overwrites_with_null_without_keep(rows):
    target = rows(TARGET, (1, "01", "a", 5.0, "S1"))
    source = rows("code string, name string, area double", ("01", "b", None))
    merged = merge.scd1_merge(target, source, "code", ["name", "area"], "key").first()
    assert merged.area is None and merged.scope == "S1"


def test_duplicate_source_keys_fail_the_merge(rows):
    target = rows(TARGET, (1, "OTH", "a", 5.0, "S1"))
    source = rows("code string, name string, area double", ("OTH", "b", 1.0), ("OTH", "c", 2.0))
    with pytest.raises(Exception, match="several source rows"):
        merge.scd1_merge(target, source, "code", ["name", "area"], "key").collect()


def test_replace_slices_reloads_years(rows):
    old = rows("y int, v int", (2022, 1), (2023, 2), (2024, 3))
    new = rows("y int, v int", (2023, 9), (2023, 8))
    once = merge.replace_slices(old, new, "y")
    assert sorted(map(tuple, once.collect())) == [(2022, 1), (2023, 8), (2023, 9), (2024, 3)]
    twice = merge.replace_slices(once, new, "y")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def at(second):
    return datetime.datetime(2024, 1, 1, 0, 0, second)


def test_audit_state(rows):
    ddl = ("event_id string, log_id string, package string, task string, status string, rows_processed int, "
           "error string, at timestamp")
    events = rows(
        ddl,
        ("1", "A", "p", "t", "RUNNING", None, None, at(0)),
        ("2", "A", "p", "t", "FAILED", 5, "bad", at(3)),
        ("3", "A", "p", "t", "SUCCESS", None, None, at(9)),
        ("4", "B", "q", None, "RUNNING", None, None, at(1)),
        ("5", None, "r", None, "SUCCESS", 7, None, at(2)),
        ("6", None, "r", None, "FAILED", None, "x", at(4)),
    )
    state = as_dicts(audit.audit_state(events))
    runs = {r["log_id"] or r["lone_event_id"]: r for r in state}
    assert len(state) == 4
    assert runs["A"]["status"] == "SUCCESS" and runs["A"]["rows_processed"] == 5 and runs["A"]["error"] is None
    assert runs["A"]["duration_s"] == 9
    assert runs["B"]["status"] == "RUNNING" and runs["B"]["end_time"] is None
    assert runs["5"]["rows_processed"] == 7 and runs["5"]["duration_s"] == 0
    assert runs["6"]["error"] == "x"


def test_lags_skip_gaps(rows):
    df = rows("k string, y int, v int", ("a", 2018, 1), ("a", 2020, 4), ("a", 2023, 8), ("b", 2050, 3))
    lagged = {(r.k, r.y): (r.v, r.v_minus_1, r.v_minus_5) for r in series.with_lags(df, ["k"], "y", "v", [1, 5], 2050).collect()}
    assert lagged[("a", 2018)] == (1, None, None)
    assert lagged[("a", 2019)] == (None, 1, None)
    assert lagged[("a", 2020)] == (4, None, None)
    assert lagged[("a", 2023)] == (8, None, 1)
    assert ("b", 2051) not in lagged


def test_keep_first_follows_the_given_order(rows):
    df = rows("y int, c string, pos int, v int", (1, "a", 2, 20), (1, "a", 1, 10), (1, "b", 3, 30), (2, "a", 9, 90))
    kept = series.keep_first(df, ["y", "c"], ["pos"])
    assert sorted(map(tuple, kept.collect())) == [(1, "a", 1, 10), (1, "b", 3, 30), (2, "a", 9, 90)]


def test_pivot_first_takes_first_value_that_is_there(rows):
    df = rows(
        "y int, i string, v double, pos int",
        (2000, "CO2", None, 0), (2000, "CO2", 5.0, 1), (2000, "CO2", 6.0, 2), (2000, "GDP", 1.0, 0),
        (2001, "CO2", None, 0), (2002, "other", 9.0, 0),
    )
    wide = as_dicts(series.pivot_first(df, "y", "i", "v", ["CO2", "GDP"], ["pos"]), "y")
    assert wide == [{"y": 2000, "CO2": 5.0, "GDP": 1.0}]


def test_running_sums_across_blocks(spark):
    values = [random.Random(3).randint(-9, 9) for _ in range(1000)]
    long = spark.createDataFrame([("hot", i, v) for i, v in enumerate(values)] + [("one", 0, 4)], "k string, p int, v int")
    found = series.running_sums(long, ["k"], "p", ["v"], block=16)
    got = {(r.k, r.p): r.running_v for r in found.collect()}
    total = 0
    for i, v in enumerate(values):
        total += v
        assert got[("hot", i)] == total
    assert got[("one", 0)] == 4 and len(got) == 1001


def test_top_of_latest_with_ties(rows):
    df = rows("y int, code string, c int", (2023, "z", 99), *((2024, f"{i:02d}", 100 - i // 2) for i in range(14)))
    top = as_dicts(ranking.top_of_latest(df, "y", "c", "code", "r", 10), "code")
    assert [t["code"] for t in top] == [f"{i:02d}" for i in range(10)]
    assert [t["r"] for t in top] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    short = ranking.top_of_latest(df.where("y = 2023 or code in ('00', '01')"), "y", "c", "code", "r", 10)
    assert sorted(r.code for r in short.collect()) == ["00", "01"]


def test_share_within(rows):
    df = rows("p string, s string, v int", ("a", "x", 1), ("a", "y", 3), ("b", "x", 0), (None, "x", 5))
    found = {(r.p, r.s): r.pct for r in ranking.share_within(df, "v", ["p"], "pct", 100.0).collect()}
    assert found == {("a", "x"): 25.0, ("a", "y"): 75.0, ("b", "x"): None, (None, "x"): 100.0}


def test_fixed_series(spark, rows):
    catalog = rows("Province_Code string, share double, hub boolean", ("01", 0.126, True), ("26", 0.015, True))
    years = allocation.with_years(catalog, 2015, 2024)
    spread = allocation.allocate_by_share(years, allocation.national_series(spark), "share", F.col("hub"))
    found = {(r.Year, r.Province_Code): r for r in spread.collect()}
    assert len(found) == 20
    assert found[(2024, "01")].GRDP_Billion_VND == 1383480.0 and found[(2024, "01")].Carbon_Mt == 117.795
    people = allocation.project_population(
        years, allocation.base_population(spark), "Province_Code", F.lit(1236.0), F.col("Year")
    )
    by = {(r.Year, r.Province_Code): r.Population for r in people.collect()}
    assert by[(2015, "01")] == 8400000 and by[(2015, "26")] == 1109000


def test_allocation(rows):
    catalog = rows("code string, share double, hub boolean", ("01", 0.126, True), ("26", 0.015, False))
    years = allocation.with_years(catalog, 2015, 2016)
    assert years.count() == 4
    national = rows("Year int, GRDP double, GHG double", (2015, 4192862.0, 350.2))
    found = {(r.Year, r.code): r for r in allocation.allocate_by_share(years, national, "share", F.col("hub")).collect()}
    first = found[(2015, "01")]
    assert first.GRDP_Billion_VND == 528300.61 and first.Carbon_Mt == 70.6 and first.Estimated_Carbon_Tonnes == 70600000
    assert first.Decoupling_Index == 133.64
    missing = found[(2016, "26")]
    assert missing.GRDP_Billion_VND == 150000.0 and missing.Carbon_Mt == 5.625
    weights = allocation.normalised_weight(catalog, "share", F.col("hub"))
    assert sum(r.weight for r in weights.collect()) == pytest.approx(1.0)


def test_catalog_dimension(rows):
    catalog = rows("code string, name string, hub int, grdp_share double", ("01", "Hà Nội", 1, 0.1))
    assert allocation.catalog_dimension(catalog).columns == ["Province_Code", "Province_Name", "Is_Industrial_Hub"]


def test_population(rows):
    places = rows("code string, area double, y int", ("01", 3359.0, 2015), ("01", 3359.0, 2024), ("26", 1236.0, 2016))
    base = rows("code string, base_thousands int", ("01", 8400))
    found = {(r.code, r.y): r.Population for r in allocation.project_population(places, base, "code", F.col("area"), F.col("y")).collect()}
    assert found == {
        ("01", 2015): 8400000,
        ("01", 2024): int(8400 * 1000 * (1.0 + 9 * 0.011)),
        ("26", 2016): int(1109 * 1000 * (1.0 + 1 * 0.011)),
    }


def test_null_natural_key_fails_the_merge(rows):
    target = rows("k bigint, code string, v int", (1, "a", 1))
    source = rows("code string, v int", ("b", 2), (None, 3))
    with pytest.raises(Exception, match="NULL in natural key code"):
        merge.scd1_merge(target, source, "code", ["v"], "k").collect()


def test_doubled_source_key_fails_even_where_only_rows_are_counted(rows):
    target = rows("k bigint, code string, v int", (1, "a", 1))
    source = rows("code string, v int", ("b", 2), ("b", 3))
    with pytest.raises(Exception, match="several source rows for key b"):
        merge.scd1_merge(target, source, "code", ["v"], "k").count()


def test_lags_keep_own_rows_after_the_last_year(rows):
    df = rows("k int, y int, v double", (1, 2050, 1.0), (1, 2051, 2.0))
    found = {r.y: (r.v, r.v_minus_1) for r in series.with_lags(df, ["k"], "y", "v", [1], 2050).collect()}
    assert found == {2050: (1.0, None), 2051: (2.0, None)}


def test_reload_takes_the_years_from_staging(rows):
    old = rows("y int, v int", (1, 1), (2, 2), (3, 3))
    staged, kept = rows("y int, v int", (2, 9), (3, 9)), rows("y int, v int", (3, 9))
    found = merge.replace_slices(old, kept, "y", staged).collect()
    assert sorted((r.y, r.v) for r in found) == [(1, 1), (3, 9)]


def test_closing_an_unknown_run_changes_nothing(rows):
    ddl = "event_id string, log_id string, package string, task string, status string, rows_processed bigint, error string, at int"
    events = rows(ddl, ("e1", "r1", "p", "t", "RUNNING", None, None, 1), ("e2", "r1", "p", "t", "SUCCESS", 5, None, 2),
                  ("e3", "gone", "p", "t", "FAILED", None, "x", 3), ("e4", None, "p", "t", "SUCCESS", 1, None, 4))
    timed = events.withColumn("at", F.timestamp_seconds("at"))
    from carbonloom.operators.audit import audit_state

    assert sorted((r.log_id or "", r.status) for r in audit_state(timed).collect()) == [("", "SUCCESS"), ("r1", "SUCCESS")]
