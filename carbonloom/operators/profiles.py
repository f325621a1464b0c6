"""Quality checks that look at changed slices only.

Every slice of a snapshot table is profiled once per load: counts, broken rules, extremes, sums, doubled keys, and sketches of distinct
values and quantiles, all of which merge. The profiles are kept as a small table of their own, by load and slice; as a
slice's files never change, a profile never goes stale. The checks read the profiles of the slices that the current snapshot
lists, after the missing ones have been taken in one scan over just those slices.

Exact: row, NULL and violation counts, minima, maxima, sums, and duplicates of a key that has the partition columns in it (equal keys
then lie in one slice). Sketched: distinct counts (HyperLogLog with 2**``LG_K`` registers: standard error
1.04 / sqrt(2**LG_K), 1.6 %) and quantiles (KLL with k = ``KLL_K``: rank error about 1.65 %, with 99 % confidence).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as k
from ..sources import snapshots
from ..sources.tables import exists
from .constraints import Rule
from .quality import gate_rows

LG_K, KLL_K = 12, 200


@dataclass(frozen=True)
class Spec:
    """What is profiled of a table. ``key`` must hold the partition columns for its duplicates to be exact."""

    dataset: str
    columns: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = field(default=())
    key: tuple[str, ...] = ()


def _profile(rows: DataFrame, spec: Spec, by: Sequence[str]) -> DataFrame:
    """One row per slice; its doubled keys come from a second scan that reads the key columns only."""
    each = [
        F.count(F.lit(1)).alias("rows"),
        F.array(*(F.count_if(F.col(c).isNull()) for c in spec.columns)).alias("nulls"),
        F.array(*(F.count_if(rule.broken) for rule in spec.rules)).cast("array<long>").alias("broken"),
        F.array(*(F.min(F.col(c).cast("double")) for c in spec.numbers)).cast("array<double>").alias("low"),
        F.array(*(F.max(F.col(c).cast("double")) for c in spec.numbers)).cast("array<double>").alias("high"),
        F.array(*(F.sum(F.col(c).cast("decimal(38,4)")) for c in spec.numbers)).cast("array<decimal(38,4)>").alias("total"),
        F.array(*(F.hll_sketch_agg(F.col(c).cast("string"), LG_K) for c in spec.columns)).alias("distinct"),
        F.array(*(F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_K) for c in spec.numbers)).cast("array<binary>").alias("quantiles"),
    ]
    found = rows.groupBy(*by).agg(*each)
    if not spec.key:
        return found.withColumn("doubled", F.lit(None).cast("long"))
    keys = rows.groupBy(*dict.fromkeys([*by, *spec.key])).agg(F.count(F.lit(1)).alias("_n"))
    doubled = keys.groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("doubled"))
    return found.join(doubled, list(by))


def refresh(spark: SparkSession, path: str, store: str, spec: Spec) -> list[str]:
    """Profiles the slices of the current snapshot that have none yet; their names."""
    now = snapshots.snapshot(spark, path)
    if now is None:
        raise FileNotFoundError(f"{path} is not loaded yet")
    if not {*spec.key} >= {*now.partition_by} and spec.key:
        raise ValueError(f"the key of {spec.dataset} must hold {', '.join(now.partition_by)}")
    known = {(r.load, r.slice) for r in _stored(spark, store, spec).select("load", "slice").collect()} if exists(spark, _folder(store, spec)) else set()
    missing = [(load, name) for name, load in sorted(now.slices.items()) if (load, name) not in known]
    if not missing:
        return []
    by = list(now.partition_by)
    profiles = _profile(snapshots.read_slices(spark, path, now, [name for _, name in missing]), spec, by)
    name = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in by))
    loads = spark.createDataFrame(missing, "load string, slice string")
    profiles.withColumn("slice", name).drop(*by).join(loads, "slice").coalesce(1).write.mode("append").parquet(_folder(store, spec))
    return [name for _, name in missing]


def _folder(store: str, spec: Spec) -> str:
    """Profiles of another specification are other profiles."""
    text = repr((spec.columns, spec.numbers, [(r.name, r.condition, r.null_ok) for r in spec.rules], spec.key))
    return f"{store}/{spec.dataset}-{hashlib.sha256(text.encode()).hexdigest()[:12]}"


def _stored(spark: SparkSession, store: str, spec: Spec) -> DataFrame:
    return spark.read.parquet(_folder(store, spec))


def merged(spark: SparkSession, path: str, store: str, spec: Spec) -> DataFrame:
    """(column, rows, nulls, distinct_estimate, min, max, mean, median_estimate) of the current snapshot, without a scan of it."""
    profiles = _current(spark, path, store, spec)

    def item(name: str, i: int):
        return F.col(name)[i]

    parts = []
    for i, c in enumerate(spec.columns):
        n = spec.numbers.index(c) if c in spec.numbers else None
        quantiles = None if n is None else F.kll_merge_agg_double(item("quantiles", n))
        parts.append(
            profiles.agg(
                F.lit(c).alias("column"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(item("nulls", i)), F.lit(0)).alias("nulls"),
                F.hll_sketch_estimate(F.hll_union_agg(item("distinct", i))).alias("distinct_estimate"),
                *(
                    [F.lit(None).cast("double").alias(x) for x in ("min", "max", "mean", "median_estimate")]
                    if n is None
                    else [
                        F.min(item("low", n)).alias("min"),
                        F.max(item("high", n)).alias("max"),
                        F.try_divide(F.sum(item("total", n)).cast("double"), F.sum(F.col("rows") - item("nulls", i))).alias("mean"),
                        F.kll_sketch_get_quantile_double(quantiles, F.lit(0.5)).alias("median_estimate"),
                    ]
                ),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _current(spark: SparkSession, path: str, store: str, spec: Spec) -> DataFrame:
    now = snapshots.snapshot(spark, path)
    listed = spark.createDataFrame([(load, name) for name, load in now.slices.items()], "load string, slice string")
    # a slice that two runs profiled at once is there twice, alike
    return _stored(spark, store, spec).join(listed, ["load", "slice"], "left_semi").dropDuplicates(["load", "slice"])


def findings(spark: SparkSession, path: str, store: str, spec: Spec, max_pct: float = k.MAX_NULL_PCT) -> DataFrame:
    """Completeness, validity and uniqueness as gate rows, exact, from the profiles alone."""
    profiles = _current(spark, path, store, spec)
    counted = profiles.agg(
        F.sum("rows").alias("_rows"),
        *(F.sum(F.col("nulls")[i]).alias(f"n{i}") for i in range(len(spec.columns))),
        *(F.sum(F.col("broken")[i]).alias(f"r{i}") for i in range(len(spec.rules))),
        F.coalesce(F.sum("doubled"), F.lit(0)).alias("doubled"),
    )

    def row(check: str, column: str, value, passed):
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(spec.dataset).alias("dataset"),
            F.lit(column).alias("column"),
            value.cast("double").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    found = []
    for i, column in enumerate(spec.columns):
        pct = F.try_divide(F.col(f"n{i}") * F.lit(100.0), F.col("_rows"))
        found.append(row("completeness", column, F.round(pct, 2), pct < max_pct))
    for i, rule in enumerate(spec.rules):
        found.append(row("validity", rule.name, F.col(f"r{i}"), F.col(f"r{i}") == 0))
    if spec.key:
        found.append(row("uniqueness", ", ".join(spec.key), F.col("doubled"), F.col("doubled") == 0))
    return gate_rows(profiled=[counted.select(F.inline(F.array(*found)))])
