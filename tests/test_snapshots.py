"""Facts in snapshots: one step per load, upserts, layout."""

import glob

import pyarrow.parquet as pq
import pytest
from carbonloom.operators.constraints import non_negative
from carbonloom.sources import snapshots
from helpers import as_dicts
from pyspark.sql import functions as F

DDL = "Date_Key int, v int"
RULE = [non_negative("v")]


def rows_of(spark, path, version=None):
    return sorted((r.Date_Key, r.v) for r in snapshots.read(spark, path, version).collect())


@pytest.fixture
def publish(rows, tmp_path):
    path = str(tmp_path / "fact")

    def run(*values, staged=None):
        df = rows(DDL, *values)
        years = snapshots.staged_slices(df if staged is None else rows("Date_Key int", *staged), ["Date_Key"])
        return snapshots.replace(df, path, ["Date_Key"], years, RULE, "v")

    run.path = path
    return run


def test_a_load_replaces_its_slices_only(spark, publish):
    publish((2022, 1), (2023, 2), (2024, 3))
    for _ in range(2):
        publish((2023, 9), (2023, 8))
    expected = [(2022, 1), (2023, 8), (2023, 9), (2024, 3)]
    assert rows_of(spark, publish.path) == expected
    with pytest.raises(Exception, match="broken rules"):
        publish((2022, 5), (2024, -1))
    with pytest.raises(ValueError, match="1 values of Date_Key, v occur more than once"):
        publish((2022, 5), (2022, 5))
    with pytest.raises(ValueError, match="not staged: Date_Key=2024"):
        publish((2022, 5), (2024, 5), staged=[(2022,)])
    assert rows_of(spark, publish.path) == expected
    # a staged year that the lookups have emptied, and one that was never loaded
    publish((2022, 7), staged=[(2022,), (2023,), (1999,), (None,)])
    assert rows_of(spark, publish.path) == [(2022, 7), (2024, 3)]
    assert rows_of(spark, publish.path, 1) == [(2022, 1), (2023, 2), (2024, 3)]
    assert snapshots.read(spark, publish.path).columns == ["v", "Date_Key"]
    publish(staged=[(2022,), (2024,)])
    assert rows_of(spark, publish.path) == []


@pytest.mark.parametrize("step", ["_write", "enforce_unique", "_publish", "rename"])
def test_a_load_killed_at_any_step_changes_nothing(spark, publish, monkeypatch, step):
    publish((2022, 1), (2023, 2))
    reader = snapshots.read(spark, publish.path)

    def killed(*_, **__):
        raise KeyboardInterrupt

    if step == "rename":  # the manifest is written aside, but not yet named
        real = snapshots._read_text
        monkeypatch.setattr(snapshots.Snapshot, "to_json", lambda self: killed())
        assert real
    else:
        done = getattr(snapshots, step)
        after = step == "_write"
        monkeypatch.setattr(snapshots, step, (lambda *a, **k: (done(*a, **k), killed())) if after else killed)
    with pytest.raises(KeyboardInterrupt):
        publish((2022, 5), (2023, 6))
    monkeypatch.undo()
    assert rows_of(spark, publish.path) == [(2022, 1), (2023, 2)]
    publish((2022, 5))
    assert rows_of(spark, publish.path) == [(2022, 5), (2023, 2)]
    # a reader that has begun keeps its snapshot
    assert sorted((r.Date_Key, r.v) for r in reader.collect()) == [(2022, 1), (2023, 2)]


def test_two_loads_at_once(spark, publish, rows, monkeypatch):
    publish((2022, 1), (2023, 2))
    write = snapshots._write

    def overtaken(*args):
        out = write(*args)
        monkeypatch.setattr(snapshots, "_write", write)
        publish((2022, 8))
        return out

    monkeypatch.setattr(snapshots, "_write", overtaken)
    with pytest.raises(snapshots.Overtaken):
        publish((2023, 9))
    assert rows_of(spark, publish.path) == [(2022, 8), (2023, 2)]
    # an upsert is merged again onto what the other load published
    monkeypatch.setattr(snapshots, "_write", overtaken)
    df = rows("Date_Key int, v int, k int", (2022, 5, 1))
    path = publish.path + "2"
    snapshots.upsert(df, path, ["Date_Key"], "k", F.col("v"))

    def other(*args):
        out = write(*args)
        monkeypatch.setattr(snapshots, "_write", write)
        snapshots.upsert(rows("Date_Key int, v int, k int", (2022, 6, 2)), path, ["Date_Key"], "k", F.col("v"))
        return out

    monkeypatch.setattr(snapshots, "_write", other)
    snapshots.upsert(rows("Date_Key int, v int, k int", (2022, 7, 3)), path, ["Date_Key"], "k", F.col("v"))
    assert sorted((r.v, r.k) for r in snapshots.read(spark, path).collect()) == [(5, 1), (6, 2), (7, 3)]


def test_upsert_and_batches(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "fact"), "Date_Key int, Month short, k int, v string, at int"

    def upsert(number, *values):
        return snapshots.upsert(rows(ddl, *values), path, ["Date_Key", "Month"], "k", F.struct("at", "v"), batch=("s", number), leave_out=["at"])

    upsert(0, (2024, 1, 1, "a", 1), (2024, 1, 1, "b", 2), (2024, 2, 2, "c", 1))
    first = snapshots.snapshot(spark, path)
    upsert(1, (2024, 1, 3, "d", 1), (2024, 1, 1, "e", 0))
    second = snapshots.snapshot(spark, path)
    assert second.slices["Date_Key=2024/Month=2"] == first.slices["Date_Key=2024/Month=2"]  # not touched, not written
    want = [(1, "e"), (2, "c"), (3, "d")]
    assert sorted((r.k, r.v) for r in snapshots.read(spark, path).collect()) == want
    upsert(1, (2024, 1, 9, "again", 1))  # the batch is published already
    upsert(0, (2024, 1, 9, "again", 1))
    assert sorted((r.k, r.v) for r in snapshots.read(spark, path).collect()) == want
    upsert(2)  # an empty batch
    assert snapshots.snapshot(spark, path).batches == {"s": 2} and "at" not in snapshots.read(spark, path).columns


def test_old_versions_go(spark, publish):
    for i in range(4):
        publish((2020 + i, i), (2030, i))
    load = snapshots.snapshot(spark, publish.path, 1).slices
    assert load["Date_Key=2020"] and rows_of(spark, publish.path) == [(2020, 0), (2021, 1), (2022, 2), (2023, 3), (2030, 3)]
    snapshots.expire(spark, publish.path, keep=1)
    assert snapshots.versions(spark, publish.path) == [4]
    assert rows_of(spark, publish.path) == [(2020, 0), (2021, 1), (2022, 2), (2023, 3), (2030, 3)]
    assert len(glob.glob(f"{publish.path}/data/*/Date_Key=2030")) == 1
    # a load that no version lists goes by age only
    orphan = snapshots._write(snapshots.read(spark, publish.path), publish.path, ["Date_Key"], snapshots.Layout())[0]
    assert snapshots.expire(spark, publish.path) == [] and snapshots.expire(spark, publish.path, unlisted_after_s=-1) == [orphan]
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, publish.path, 1)


def scanned_rows(df):
    """Rows that the file scans of an executed plan gave out."""
    plan = df._jdf.queryExecution().executedPlan()

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        if "FileSourceScan" in node.getClass().getSimpleName():
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(plan)


def test_clustered_slices_spare_row_groups(spark, tmp_path):
    stations, path = 400, str(tmp_path / "fact")
    days = spark.range(stations * 366).select(
        F.lit(2024).alias("Date_Key"), (F.col("id") % stations + 1).alias("Station_Key"), F.floor(F.col("id") / stations + 1).cast("int").alias("Day_Of_Year"),
        F.xxhash64("id").alias("Reading"),
    ).withColumn("Month", F.month(F.date_add(F.lit("2023-12-31").cast("date"), F.col("Day_Of_Year"))).cast("short"))
    layout = snapshots.Layout((("Station_Key", 1, stations), ("Day_Of_Year", 1, 366)), bloom=("Station_Key",), bloom_values=stations, row_group=16 << 10)
    snapshots.replace(days, path, ["Date_Key"], ["Date_Key=2024"], layout=layout)
    files = [pq.ParquetFile(f) for f in glob.glob(f"{path}/data/*/*/*.parquet")]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.metadata.num_row_groups)]
    names = files[0].schema_arrow.names

    def meets(group, column, value):
        stats = group.column(names.index(column)).statistics
        return stats.min <= value <= stats.max

    met = [g for g in groups if meets(g, "Station_Key", 77) and meets(g, "Month", 3)]
    assert len(groups) >= 60 and len(met) < 0.05 * len(groups)
    one = snapshots.read(spark, path).where("Station_Key = 77 AND Month = 3")
    assert one.count() == 31
    found = one.select("Reading")
    found.collect()
    assert scanned_rows(found) < 0.05 * days.count()
    # a station that no row has: the Bloom filters leave nothing to read
    none = snapshots.read(spark, path).where("Station_Key = 1000000").select("Reading")
    assert none.collect() == [] and scanned_rows(none) == 0


def test_curve_is_the_interleaved_bits(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).cast("int").alias("b"))
    at = snapshots.curve((("a", 0, 15), ("b", 0, 15)))
    for r in as_dicts(df.withColumn("at", at)):
        want = sum((r["a"] >> i & 1) << (2 * i + 1) | (r["b"] >> i & 1) << (2 * i) for i in range(4)) << 24
        assert r["at"] == want
    outside = spark.createDataFrame([(-5, 99), (None, 7)], "a int, b int").select(at.alias("at")).collect()
    assert [r["at"] for r in outside] == [sum(1 << (2 * i) for i in range(4)) << 24, sum((7 >> i & 1) << (2 * i) for i in range(4)) << 24]


def test_rows_that_are_alike_are_dealt_by_what_they_take_unpacked(spark, tmp_path, monkeypatch):
    """They pack to almost nothing, but the task that writes them sorts them all."""
    monkeypatch.setattr(snapshots, "TASK_BYTES", 10_000 * (2 * 8 + 40 + 4), raising=False)
    year = F.when(F.col("id") < 40_000, 2024).when(F.col("id") < 40_010, 2023).when(F.col("id") < 40_020, 2022)
    alike = spark.range(0, 40_030, 1, 8).select(year.cast("int").alias("Date_Key"), F.lit("same").alias("v"))
    for df in (alike, alike.where("Date_Key < 0")):
        path = str(tmp_path / f"fact{df.isEmpty()}")
        snapshots.replace(df, path, ["Date_Key"], ["Date_Key=2022", "Date_Key=2023", "Date_Key=2024", "Date_Key=__HIVE_DEFAULT_PARTITION__"])
        assert snapshots.read(spark, path).groupBy("Date_Key").count().exceptAll(df.groupBy("Date_Key").count()).isEmpty()
    of_year = {y: [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/factFalse/data/*/Date_Key={y}/*.parquet")] for y in (2022, 2023, 2024)}
    assert sum(of_year[2024]) == 40_000 and max(of_year[2024]) <= 15_000
    assert of_year[2022] == of_year[2023] == [10]
