"""A whole load from files to views, run twice."""

import pytest

from carbonloom.plans import measures
from carbonloom.plans.jobs import Warehouse
from carbonloom.streaming import hourly_feed
from carbonloom.sources import schemas
from helpers import as_dicts, by_key

PROVINCES = """﻿Province_Code,Province_Name,Province_Name_Ascii,Region,Economic_Zone,Area_Km2,Is_Industrial_Hub
01,Hà Nội,Ha Noi,Đồng bằng sông Hồng,KTTĐ Bắc Bộ,3359.8,1
26,Vĩnh Phúc,Vinh Phuc,Đồng bằng sông Hồng,KTTĐ Bắc Bộ,,0
"""
STATIONS = """Station_Code,Station_Name,Province_Code,Province_Name,Station_Type,Latitude,Longitude,Is_Active
ST-01-01,Trạm A,01,Hà Nội,Khu Công Nghiệp,20.586199,106.536928,1
ST-26-01,Trạm B,26,Vĩnh Phúc,Đô Thị Giao Thông,21.1,105.5,1
ST-99-01,Trạm C,99,Nowhere,Đô Thị Giao Thông,21.1,105.5,0
"""
NATIONAL = """Year,CO2_MtCO2e,CO2_Per_Capita_Tonnes,GDP_USD,Methane_MtCO2e,Renewable_Energy_Pct,Total_GHG_MtCO2e
2019,5.5,0.1,1000,2.5,30.5,9
2020,6.5,0.1,2000,2.5,,10
"""
SECTORS = """Year,Sector_Code,Sector_Name_EN,Sector_Name_VI,Sector_Category,Gas,Source,Emissions_MtCO2e
2020,ENG,Energy,Năng lượng mới,Energy,All GHG,CAIT,60
2020,TOT,Total,Tổng,Total,All GHG,CAIT,100
2020,wst,Waste,Xử lý,Waste,All GHG,CAIT,
2021,TOT,Total,Tổng,Total,All GHG,CAIT,110
"""
PROVINCIAL = ("Year,Province_Code,Province_Name,GRDP_Billion_VND,Population,Industrial_Output_Billion_VND,"
              "Forest_Coverage_Pct,Estimated_Carbon_Tonnes,Decoupling_Index\n"
              "2020,01,Hà Nội,100,1000,50,5.5,250,0.8\n2020,26,Vĩnh Phúc,,0,0,5.5,10,\n2020,77,X,1,1,1,1,1,1\n")
HEADER = ",".join(s.split()[0] for s in schemas.HOURLY.split(", "))
READING = "2024,2024,{m},{d},{h},{s},{p},500.10,1.00,20.00,10.00,{pm},50.00,74,Trung bình,{x}"
HOURLY = "\n".join(
    [HEADER]
    + [READING.format(m=m, d=1, h=h, s=s, p=p, pm="60.00" if h == 7 else "30.00", x=int(h == 7))
       for m in (1, 2) for h in (0, 7) for s, p in (("ST-01-01", "01"), ("ST-26-01", "26"), ("ST-XX", "01"))]
    + ["2024,2024,1", ""]
)


VIEWS = ("vw_dim_date", "vw_dim_time_of_day", "vw_dim_province", "vw_dim_sector", "vw_dim_station",
         "vw_fact_national", "vw_fact_provincial", "vw_fact_hourly")


@pytest.fixture
def warehouse(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "dwh"))
    for name, text in (("national", NATIONAL), ("sectors", SECTORS), ("provincial", PROVINCIAL),
                       ("provinces", PROVINCES), ("stations", STATIONS), ("hourly", HOURLY)):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        if name != "hourly":
            w.stage_csv(name, str(tmp_path / f"{name}.csv"))
    return w


def test_full_load_twice(warehouse, tmp_path):
    w = warehouse
    assert w.stage_hourly(str(tmp_path / "hourly.csv")) == {"kept": 12, "dropped": 1}
    snapshots = []
    for _ in range(2):
        w.seed_dimensions()
        w.load_yearly()
        w.load_stations()
        w.load_hourly_fact()
        snapshots.append({name: as_dicts(w.view(name), w.view(name).columns[0]) for name in VIEWS})
    assert snapshots[0] == snapshots[1]
    views = snapshots[0]
    assert len(views["vw_dim_date"]) == 81 and len(views["vw_dim_time_of_day"]) == 24

    sectors = {r["Sector_Code"]: r for r in views["vw_dim_sector"]}
    assert len(sectors) == 10 and sectors["ENG"]["Sector_Name_VI"] == "Năng lượng mới"
    assert sectors["ENG"]["Scope_Type"] == "Scope 1" and sectors["WST"]["Scope_Type"] == "Scope 1 & 2"
    assert sectors["WST"]["Sector_Hierarchy_Path"] == "Scope 1 & 2 > Waste > Xử lý"

    national = {(r["Year"], r["Sector_Code"]): r for r in views["vw_fact_national"]}
    assert set(national) == {(2020, "ENG"), (2020, "TOT"), (2020, "WST"), (2021, "TOT")}
    assert national[(2020, "WST")]["Emissions_MtCO2e"] == 0
    assert national[(2020, "TOT")]["GDP_USD"] == 2000 and national[(2020, "ENG")]["GDP_USD"] is None
    assert national[(2020, "ENG")]["CO2_MtCO2e"] == national[(2020, "TOT")]["CO2_MtCO2e"]
    assert national[(2021, "TOT")]["CO2_MtCO2e"] is None

    provincial = {r["Province_Code"]: r for r in views["vw_fact_provincial"]}
    assert set(provincial) == {"01", "26"}
    assert provincial["01"]["Carbon_Intensity_Tonnes_Per_Billion_VND"] == 2.5
    assert provincial["01"]["Decoupling_Status"].startswith("Tách rời yếu")
    assert provincial["26"]["Carbon_Intensity_Tonnes_Per_Billion_VND"] == 0
    assert provincial["26"]["Carbon_Density_Tonnes_Per_Km2"] == 0 and provincial["26"]["GRDP_Billion_VND"] == 0

    assert {r["Station_Code"] for r in views["vw_dim_station"]} == {"ST-01-01", "ST-26-01"}
    hourly = views["vw_fact_hourly"]
    assert len(hourly) == 8 and len({r["Monitoring_ID"] for r in hourly}) == 8
    assert "Month" not in hourly[0] and sum(r["Is_Exceeding_QCVN"] for r in hourly) == 4

    by = ["Region", "Station_Type", "Time_Bucket"]
    over_view = measures.measure(w.view("vw_fact_hourly"), list(measures.AIR), by)
    assert as_dicts(w.air_measures(by), *by) == as_dicts(over_view, *by) and over_view.count() == 4

    lost = {(r.fact, r.lookup): r.rows_lost for r in w.orphans().collect()}
    assert lost[("provincial", "province")] == 1 and lost[("sectors", "sector")] == 0
    assert lost[("hourly", "station")] == 4 and lost[("hourly", "date")] == lost[("hourly", "hour")] == 0
    audit = as_dicts(w.audit())
    assert len([r for r in audit if r["status"] == "SUCCESS"]) == 4
    warned = [(r["task"], r["rows_processed"]) for r in audit if r["status"] != "SUCCESS"]
    assert warned == [("provincial: rows lost by province", 1)] * 2
    assert {r["rows_processed"] for r in audit if r["package"] == "facts" and r["status"] == "SUCCESS"} == {2}

    gate = by_key(w.gate(required_years=(2020,), provinces=2), "check")
    assert not gate["referential"]["passed"] and not gate["overall"]["passed"] and gate["uniqueness"]["passed"]


def test_failed_load_leaves_the_fact_and_is_audited(warehouse, spark):
    w = warehouse
    w.seed_dimensions()
    w.load_yearly()
    before = as_dicts(w.read("fact_provincial"), "Economy_ID")
    bad = w.staged("provincial").selectExpr("* except (Population)", "-Population - 1 as Population")
    bad.write.mode("overwrite").parquet(w.path("bad"))
    w.stage("provincial", spark.read.parquet(w.path("bad")), "bad.csv")
    with pytest.raises(Exception, match="broken rules"):
        w.run("facts", "national and provincial", w.load_yearly_facts, "fact_provincial")
    assert as_dicts(w.read("fact_provincial"), "Economy_ID") == before
    failed = [r for r in as_dicts(w.audit()) if r["status"] == "FAILED"]
    assert len(failed) == 1 and "Population >= 0" in failed[0]["error"]
    w.truncate_staging()
    assert w.staged("provincial").count() == 0
    w.load_dimensions()
    assert w.read("dim_province").count() == 2


def test_streamed_bulk_load_takes_each_file_once(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.csv").write_text(HOURLY, encoding="utf-8")

    def load():
        feed = hourly_feed.readings_stream(spark, folder, files_per_batch=1)
        hourly_feed.load_available(feed, out, checkpoint).awaitTermination(120)
        return spark.read.parquet(out).count()

    assert load() == 24
    assert load() == 24
    (tmp_path / "in" / "c.csv").write_text(HOURLY, encoding="utf-8")
    assert load() == 36


def test_reload_replaces_whole_staged_years(warehouse, tmp_path):
    w = warehouse
    w.seed_dimensions()
    w.load_yearly()
    w.load_stations()
    w.load_hourly(str(tmp_path / "hourly.csv"))
    assert w.read("fact_hourly").count() == 8
    trail = [(r.task, r.rows_processed) for r in w.audit().where("status = 'WARNING' AND package = 'hourly'").collect()]
    assert sorted(trail) == [("hourly: rows lost by station", 4), ("lines with too few fields", 1)]
    # only January again: the other month goes; then only readings of unknown stations: the year is empty
    january = "\n".join(line for line in HOURLY.split("\n") if not line.startswith("2024,2024,2,"))
    (tmp_path / "january.csv").write_text(january, encoding="utf-8")
    w.load_hourly(str(tmp_path / "january.csv"))
    assert w.read("fact_hourly").count() == 4
    orphans = "\n".join(line for line in HOURLY.split("\n") if "ST-XX" in line)
    (tmp_path / "orphans.csv").write_text(orphans, encoding="utf-8")
    w.load_hourly(str(tmp_path / "orphans.csv"))
    assert w.read("fact_hourly").count() == 0


def test_unknown_gas_and_doubled_reading_fail_the_load(warehouse, spark, tmp_path):
    w = warehouse
    w.seed_dimensions()
    w.load_yearly()
    other = w.staged("sectors").selectExpr("* except (Gas)", "'CF4' as Gas")
    other.write.parquet(w.path("other"))
    w.stage("sectors", spark.read.parquet(w.path("other")), "other.csv")
    with pytest.raises(Exception, match="unknown gas: CF4"):
        w.load_yearly_facts()
    w.load_stations()
    lines = HOURLY.split("\n")
    (tmp_path / "twice.csv").write_text("\n".join([*lines[:2], lines[1]]), encoding="utf-8")
    w.stage_hourly(str(tmp_path / "twice.csv"))
    with pytest.raises(ValueError, match="Monitoring_ID occur more than once"):
        w.load_hourly_fact()


def reads_the_star(df):
    return "Station_Key" in df._jdf.queryExecution().executedPlan().toString()


def test_stored_sums_and_profiles_follow_the_fact(warehouse, tmp_path):
    w = warehouse
    w.seed_dimensions()
    w.load_yearly()
    w.load_stations()
    w.load_hourly(str(tmp_path / "hourly.csv"))
    by = ["Region", "Is_Rush_Hour"]
    plain = as_dicts(w.air_measures(by), *by)
    w.store_air_sums([("Region", "Station_Type", "Is_Rush_Hour")])
    stored = w.air_measures(by)
    assert reads_the_star(w.view("vw_fact_hourly")) and not reads_the_star(stored) and as_dicts(stored, *by) == plain
    gate = {r.column: r.passed for r in w.fact_findings("fact_hourly").where("check = 'uniqueness'").collect()}
    assert gate == {"Date_Key, Month, Monitoring_ID": True}
    january = "\n".join(line for line in HOURLY.split("\n") if not line.startswith("2024,2024,2,"))
    (tmp_path / "january.csv").write_text(january, encoding="utf-8")
    w.load_hourly(str(tmp_path / "january.csv"))
    # the sums are of another version now: the star answers
    assert reads_the_star(w.air_measures(by))
    assert sum(r["Exceeding_QCVN_Hours"] for r in as_dicts(w.air_measures(by))) == 2
    assert all(r.passed for r in w.fact_findings("fact_hourly").collect()) and all(r.passed for r in w.fact_findings("fact_national").collect())
    w.expire(keep=1)
    assert w.read("fact_hourly").count() == 4


def test_audit_files_are_compacted(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "dwh"))
    assert w.compact_audit() == 0
    for i in range(4):
        run = w.log("p", "RUNNING", f"t{i}")
        w.log("p", "SUCCESS" if i % 2 else "FAILED", f"t{i}", run, i, None if i % 2 else "no")
    before = as_dicts(w.audit(), "log_id")
    assert len(before) == 4 and w.compact_audit() >= 8 and w.compact_audit() == 0
    assert as_dicts(w.audit(), "log_id") == before
    open_run = w.log("p", "RUNNING", "t9")
    assert len(as_dicts(w.audit())) == 5
    # stopped between the archive and the files: every event counts once
    monkeypatch.setattr("carbonloom.plans.jobs.remove", lambda *_: None)
    w.compact_audit()
    w.log("p", "SUCCESS", "t9", open_run, 7)
    monkeypatch.undo()
    found = as_dicts(w.audit(), "log_id")
    assert len(found) == 5 and [r["rows_processed"] for r in found if r["task"] == "t9"] == [7]
    w.compact_audit()
    assert as_dicts(w.audit(), "log_id") == found
