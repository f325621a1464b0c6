"""Readings streamed into the fact against one batch load of the same readings."""

import random
import shutil

import pytest
from carbonloom.plans.jobs import Warehouse
from carbonloom.sources import schemas, snapshots
from carbonloom.streaming import hourly_feed
from helpers import as_dicts
from pyspark.sql import functions as F
from test_jobs import HEADER, NATIONAL, PROVINCES, PROVINCIAL, SECTORS, STATIONS

LINE = "2024,2024,{m},{d},{h},{s},{p},500.10,1.00,20.00,10.00,{pm:.2f},50.00,74,Trung bình,0"
PLACES = (("ST-01-01", "01"), ("ST-26-01", "26"), ("ST-XX", "01"))


def reading(m, d, h, s, p, pm=30):
    return LINE.format(m=m, d=d, h=h, s=s, p=p, pm=pm)


def all_readings():
    return [reading(m, d, h, s, p, 20 + h) for m in (1, 2, 3) for d in (1, 9, 28) for h in (0, 7, 23) for s, p in PLACES]


@pytest.fixture
def make(spark, tmp_path):
    def run(name):
        w = Warehouse(spark, str(tmp_path / name))
        for table, text in (("national", NATIONAL), ("sectors", SECTORS), ("provincial", PROVINCIAL), ("provinces", PROVINCES), ("stations", STATIONS)):
            (tmp_path / f"{table}.csv").write_text(text, encoding="utf-8")
            w.stage_csv(table, str(tmp_path / f"{table}.csv"))
        w.seed_dimensions()
        w.load_yearly()
        w.load_stations()
        return w

    return run


@pytest.fixture
def batch_load(make, tmp_path):
    """The fact of one batch load of some lines."""

    def run(lines):
        w = make("batch")
        (tmp_path / "all.csv").write_text("\n".join([HEADER, *lines]), encoding="utf-8")
        w.load_hourly(str(tmp_path / "all.csv"))
        return as_dicts(w.read("fact_hourly"), "Monitoring_ID")

    return run


def deliver(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]), encoding="utf-8")


def stream(w, folder, checkpoint, **options):
    query = w.stream_hourly(str(folder), str(checkpoint), files_per_batch=1, **options)
    query.awaitTermination(300)
    return query


@pytest.mark.parametrize("now", ["2024-03-29", "2024-02-05", "2030-01-01"])
def test_twice_late_and_out_of_order(spark, make, batch_load, tmp_path, now):
    """Whether readings pass through the state store, by it, or partly so."""
    lines = all_readings()
    want = batch_load(lines)
    rng = random.Random(1)
    shuffled = lines[:]
    rng.shuffle(shuffled)
    w, folder = make("streamed"), tmp_path / "in"
    options = {"now": F.lit(now).cast("timestamp"), "delay": "40 days"}
    for i in range(4):
        deliver(folder, f"{i}.csv", shuffled[i::4] + rng.sample(lines, 10))
    stream(w, folder, tmp_path / "cp", **options)
    deliver(folder, "again.csv", lines)  # all of them again
    stream(w, folder, tmp_path / "cp", **options)
    assert as_dicts(w.read("fact_hourly").select(*want[0]), "Monitoring_ID") == want
    lost = spark.read.option("recursiveFileLookup", "true").parquet(f"{w.path('fact_hourly')}/unmatched")
    assert {r.Station_Code for r in lost.collect()} == {"ST-XX"}
    assert lost.select("Month", "Day", "Hour_24").distinct().count() == 27
    assert w.view("vw_fact_hourly").count() == len(want) == 54


def test_the_state_store_knows_redeliveries(spark, make, tmp_path):
    w, folder = make("streamed"), tmp_path / "in"
    lines = [x for x in all_readings() if x.startswith("2024,2024,3,")]
    for name in ("a.csv", "b.csv"):
        deliver(folder, name, lines)
    query = stream(w, folder, tmp_path / "cp", now=F.lit("2024-03-29").cast("timestamp"), delay="40 days")
    # the second delivery reached the state, was known there, and touched nothing
    state = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    assert max(s.numRowsTotal for s in state) == 27 and sum(s.numRowsUpdated for s in state) == 27
    assert sum(s.numRowsDroppedByWatermark for s in state) == 0
    of = snapshots.snapshot(spark, w.path("fact_hourly"))
    assert of.version == len({b.batchId for b in query.recentProgress}) and len(of.slices) == 1


def test_a_correction_replaces_the_reading(spark, make, tmp_path):
    w, folder = make("streamed"), tmp_path / "in"
    deliver(folder, "a.csv", [reading(1, 1, 7, "ST-01-01", "01", 30), reading(1, 1, 8, "ST-01-01", "01", 30)])
    stream(w, folder, tmp_path / "cp")
    deliver(folder, "b.csv", [reading(1, 1, 7, "ST-01-01", "01", 44)])
    stream(w, folder, tmp_path / "cp")
    assert [float(r["PM25_ug_m3"]) for r in as_dicts(w.read("fact_hourly"), "Monitoring_ID")] == [44, 30]


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_restart_in_mid_batch_loses_and_doubles_nothing(spark, make, batch_load, tmp_path, monkeypatch, step):
    lines = all_readings()
    want = batch_load(lines)
    w, folder = make("streamed"), tmp_path / "in"
    for i in range(3):
        deliver(folder, f"{i}.csv", lines[i::3])
    publish, calls = snapshots._publish, []

    def killed(*args):
        calls.append(1)
        if len(calls) != 2:
            return publish(*args)
        if step == "after":
            publish(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(snapshots, "_publish", killed)
    with pytest.raises(Exception, match="killed"):
        stream(w, folder, tmp_path / "cp")
    assert len(calls) == 2
    stream(w, folder, tmp_path / "cp")
    assert as_dicts(w.read("fact_hourly").select(*want[0]), "Monitoring_ID") == want
    # a stream that begins anew takes all files again: still the same fact
    shutil.copytree(folder, tmp_path / "in2")
    stream(w, tmp_path / "in2", tmp_path / "cp2")
    assert as_dicts(w.read("fact_hourly").select(*want[0]), "Monitoring_ID") == want


def test_redeliveries_of_a_batch_are_told_by_all_values(spark, tmp_path):
    """The same stream operator over rows of a table."""
    ddl = ", ".join(schemas.HOURLY.split(", ")[:7])
    row = (2024, 2024, 1, 1, 7, "S", "01")
    spark.createDataFrame([row, row, (2024, 2024, 1, 1, None, "S", "01"), (2024, 2024, 1, 1, 8, "S", "01")], ddl).write.parquet(str(tmp_path / "t"))
    readings = spark.readStream.schema(ddl).parquet(str(tmp_path / "t"))
    once = hourly_feed.without_redeliveries(readings, "3 days", F.lit("2024-01-02").cast("timestamp"))
    query = once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(r.Hour_24 or -1 for r in spark.table("once").collect()) == [-1, 7, 8]
