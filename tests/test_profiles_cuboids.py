"""Checks that read changed slices only, and measures from stored sums."""

import pytest
from carbonloom.operators import profiles
from carbonloom.operators.constraints import non_negative
from carbonloom.plans import cuboids
from carbonloom.sources import snapshots
from carbonloom.plans.standin import stand_in
from helpers import as_dicts, by_key
from pyspark.sql import functions as F
from test_oracle import SF_DIR, pytestmark  # noqa: F401

SPEC = profiles.Spec("t", ("k", "v"), ("v",), (non_negative("v"),), ("Date_Key", "k"))


def load(spark, path, year, values):
    rows = spark.createDataFrame([(year, k, v) for k, v in values], "Date_Key int, k int, v double")
    snapshots.replace(rows, path, ["Date_Key"], [f"Date_Key={year}"])


def test_only_changed_slices_are_read(spark, tmp_path, monkeypatch):
    path, store = str(tmp_path / "fact"), str(tmp_path / "profiles")
    for year in (2020, 2021, 2022):
        load(spark, path, year, [(i, float(i)) for i in range(100)])
    read = []
    slices = snapshots.read_slices
    monkeypatch.setattr(snapshots, "read_slices", lambda s, p, of, names=None: read.append(names) or slices(s, p, of, names))
    assert profiles.refresh(spark, path, store, SPEC) == ["Date_Key=2020", "Date_Key=2021", "Date_Key=2022"]
    assert profiles.refresh(spark, path, store, SPEC) == []
    load(spark, path, 2021, [(1, -1.0), (1, None), (2, 7.5), (None, 1.0)])
    read.clear()
    assert profiles.refresh(spark, path, store, SPEC) == ["Date_Key=2021"] and read == [["Date_Key=2021"]]
    found = by_key(profiles.merged(spark, path, store, SPEC), "column")
    assert found["v"]["rows"] == found["k"]["rows"] == 204 and found["v"]["nulls"] == found["k"]["nulls"] == 1
    assert (found["v"]["min"], found["v"]["max"]) == (-1, 99) and found["v"]["mean"] == pytest.approx((2 * 4950 + 7.5) / 203)
    gate = {(r.check, r.column): (r.value, r.passed) for r in profiles.findings(spark, path, store, SPEC).collect()}
    assert gate["validity", "v >= 0"] == (1, False) and gate["uniqueness", "Date_Key, k"] == (1, False)
    assert gate["completeness", "v"] == (0.49, True)
    snapshots.replace(spark.createDataFrame([], "Date_Key int, k int, v double"), path, ["Date_Key"], ["Date_Key=2021"])
    assert profiles.refresh(spark, path, store, SPEC) == [] and by_key(profiles.merged(spark, path, store, SPEC), "column")["k"]["rows"] == 200


def test_sketches_keep_their_bounds(spark, tmp_path):
    path, store = str(tmp_path / "fact"), str(tmp_path / "profiles")
    n = 40_000
    rows = spark.range(n).select((F.col("id") % 8 + 2000).cast("int").alias("Date_Key"), F.col("id").cast("int").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10_007)) / 7).alias("v"))
    snapshots.replace(rows, path, ["Date_Key"], snapshots.staged_slices(rows, ["Date_Key"]))
    profiles.refresh(spark, path, store, SPEC)
    found = by_key(profiles.merged(spark, path, store, SPEC), "column")
    assert abs(found["k"]["distinct_estimate"] / n - 1) < 3 * 0.0163
    middle = found["v"]["median_estimate"]
    rank = rows.where(F.col("v") <= middle).count() / n
    assert abs(rank - 0.5) < 2 * 0.0165


def test_the_key_must_hold_the_partition(spark, tmp_path):
    load(spark, str(tmp_path / "fact"), 2020, [(1, 1.0)])
    with pytest.raises(ValueError, match="must hold Date_Key"):
        profiles.refresh(spark, str(tmp_path / "fact"), str(tmp_path / "p"), profiles.Spec("t", ("k",), key=("k",)))


GRAINS = (("Province_Code", "Region", "Station_Type", "Time_Bucket", "Is_Rush_Hour"), ("Region", "Time_Bucket"), ("Region", "Is_Rush_Hour"))


def close(a, b):
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert x.keys() == y.keys()
        for c in x:
            assert x[c] == (pytest.approx(y[c], rel=1e-12) if isinstance(y[c], float) else y[c]), c


def test_stored_sums_answer_as_the_star_does(spark, tmp_path):
    w, path, of = stand_in(spark, SF_DIR), str(tmp_path / "cuboids"), {"version": 3}
    rows = cuboids.star_rows(w.hourly_fact, w.dates, w.hours, w.provinces, w.stations)
    cuboids.store(rows, path, GRAINS, of)
    sizes = cuboids.stored_grains(spark, path, of)
    assert set(sizes) == {cuboids.label(g) for g in GRAINS} and cuboids.stored_grains(spark, path, {"version": 4}) == {}
    assert cuboids.coarsest(sizes, ["Region"]) == "Is_Rush_Hour+Region" and cuboids.coarsest(sizes, ["Year"]) is None
    for by in (["Region"], ["Region", "Time_Bucket"], ["Region", "Is_Rush_Hour"], ["Station_Type", "Is_Rush_Hour"], ["Province_Code", "Station_Type"]):
        found = cuboids.answer(spark, path, of, by)
        close(as_dicts(found, *by), as_dicts(w.air_measures(by), *by))
        assert "events" not in found._jdf.queryExecution().executedPlan().toString()
    some = cuboids.answer(spark, path, of, ["Region"], F.col("Time_Bucket").isNotNull() & (F.col("Station_Type") != "x"), ["Time_Bucket", "Station_Type"])
    close(as_dicts(some, "Region"), as_dicts(w.air_measures(["Region"]), "Region"))
    assert cuboids.answer(spark, path, of, ["Station_Name"]) is None
    cuboids.store(rows, path, GRAINS[1:], {"version": 4})
    assert set(cuboids.stored_grains(spark, path, {"version": 4})) == {cuboids.label(g) for g in GRAINS[1:]}
