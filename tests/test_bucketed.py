"""Merges on bucketed tables: the result of the plain merge, without an exchange of the target."""

import glob
import re

import pytest
from carbonloom.operators import bucketed, merge
from helpers import as_dicts
from pyspark.sql import functions as F


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def scans_below_exchanges(df):
    """(scans of bucketed files, how many of them are exchanged before they meet a join or are summed up)."""
    found = [0, 0]

    def walk(node, moved):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.initialPlan(), moved)
        if name == "ShuffleExchangeExec":
            moved = True
        if "Join" in name or "Aggregate" in name:
            moved = False
        if name == "FileSourceScanExec" and node.bucketedScan():
            found[0] += 1
            found[1] += moved
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), moved)

    walk(df._jdf.queryExecution().executedPlan(), False)
    return found


def test_merge_in_buckets(spark, no_broadcast, tmp_path):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = (F.lit("old").alias("name"), F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("v"), F.lit("x").alias("fixed"))
    start = spark.range(2000).select((F.col("id") + 1).alias("sk"), (F.col("id") * 2).alias("code"), *columns)
    target = bucketed.create(start, "dim_v1", str(tmp_path / "v1"), "code", n)
    assert len(glob.glob(str(tmp_path / "v1" / "*.parquet"))) == n
    source = spark.range(1000).select((F.col("id") * 3).alias("code"), F.lit("new").alias("name"), F.when(F.col("id") % 2 > 0, F.lit(7.0)).alias("v"))
    options = {"keep_if_null": ["v"], "insert_default": {"v": 0.5}}
    found = bucketed.merged(target, source, "code", ["name", "v"], "sk", **options)
    want = merge.scd1_merge(start, source, "code", ["name", "v"], "sk", **options)
    assert as_dicts(found, "code") == as_dicts(want, "code") and found.schema.names == start.schema.names
    scans, moved = scans_below_exchanges(found)
    assert scans >= 3 and moved == 0  # the join, the anti join and the last key
    second = bucketed.save(found, "dim_v2", str(tmp_path / "v2"), "code", n)
    assert len(glob.glob(str(tmp_path / "v2" / "*.parquet"))) == n
    again = bucketed.merged(second, source, "code", ["name", "v"], "sk", **options)
    assert as_dicts(again, "code") == as_dicts(want, "code")
    with pytest.raises(ValueError, match="there already"):
        bucketed.save(found, "dim_v2", str(tmp_path / "v3"), "code", n)
    third = bucketed.attach(spark, "dim_again", str(tmp_path / "v2"), "sk long, code long, name string, v double, fixed string", "code", n)
    assert as_dicts(third, "code") == as_dicts(want, "code")
    assert re.search("Bucketed: true", third.join(source, "code")._jdf.queryExecution().executedPlan().toString())
    for name in ("dim_v1", "dim_v2", "dim_again"):
        spark.sql(f"DROP TABLE {name}")


def test_doubled_and_null_keys_fail(spark, rows, tmp_path):
    target = bucketed.create(rows("sk long, code string, v int", (1, "a", 1)), "dim_f1", str(tmp_path / "f1"), "code", 2)
    for bad in (rows("code string, v int", ("b", 1), ("b", 2)), rows("code string, v int", (None, 1))):
        with pytest.raises(Exception, match="several source rows|NULL in natural key"):
            bucketed.merged(target, bad, "code", ["v"], "sk").collect()
    empty = bucketed.merged(target, rows("code string, v int"), "code", ["v"], "sk")
    assert as_dicts(empty) == [{"sk": 1, "code": "a", "v": 1}]
    spark.sql("DROP TABLE dim_f1")
