"""Data-quality checks. Each yields rows; the gate is their conjunction."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k
from .constraints import Rule
from .quantiles import bracket, exact_medians, value_pairs


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def completeness(df: DataFrame, dataset: str, columns: Sequence[str], max_pct: float = k.MAX_NULL_PCT) -> DataFrame:
    """(dataset, column, null_count, null_pct, passed); all columns in one pass. No rows means failed."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns))
    )
    rows = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count")) for i, c in enumerate(columns))
    )
    pct = F.try_divide(F.col("null_count") * F.lit(100.0), F.col("_rows"))
    return counted.select("_rows", F.inline(rows)).select(
        F.lit(dataset).alias("dataset"),
        "column",
        "null_count",
        F.round(pct, 2).alias("null_pct"),
        F.coalesce(pct < max_pct, F.lit(False)).alias("passed"),
    )


def uniqueness(df: DataFrame, dataset: str, key: Sequence[str]) -> DataFrame:
    """(dataset, grain, duplicates, passed): rows beyond the first per key; NULL keys form one group."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    duplicates = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return per_key.agg(duplicates.alias("duplicates")).select(
        F.lit(dataset).alias("dataset"),
        F.lit(", ".join(key)).alias("grain"),
        "duplicates",
        (F.col("duplicates") == 0).alias("passed"),
    )


def year_coverage(sources: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(year, one flag per source): distinct years only, one aggregate over all sources."""
    names = list(sources)
    parts = [
        df.select(year.cast("int").alias("year")).where(F.col("year").isNotNull()).distinct().select(
            "year", F.lit(name).alias("source")
        )
        for name, (df, year) in sources.items()
    ]
    return union_all(parts).groupBy("year").agg(
        *(F.bool_or(F.col("source") == name).alias(f"in_{name}") for name in names)
    )


def common_years(coverage: DataFrame) -> DataFrame:
    flags = [F.col(c) for c in coverage.columns if c.startswith("in_")]
    return coverage.where(reduce(Column.__and__, flags)).select("year")


def year_consistency(
    coverage: DataFrame, required: Sequence[int] = k.REQUIRED_YEARS, at_least: int = k.MIN_COMMON_YEARS
) -> DataFrame:
    """One row: the range per source, the number of common years and the verdict."""
    flags = [c for c in coverage.columns if c.startswith("in_")]
    common = reduce(Column.__and__, [F.col(c) for c in flags])
    ranges = [
        agg(F.when(F.col(c), F.col("year"))).alias(f"{label}_{c[3:]}")
        for c in flags
        for label, agg in (("first", F.min), ("last", F.max))
    ]
    found = F.count_if(common & F.col("year").isin(*required))
    enough = (F.count_if(common) >= at_least) & (found == len(set(required)))
    return coverage.agg(*ranges, F.count_if(common).alias("common_year_count"), enough.alias("passed"))


def reference_counts(
    fact: DataFrame, fact_code: str, dim: DataFrame, dim_code: str, expected: int | None = k.PROVINCE_COUNT
) -> DataFrame:
    """(dim_codes, fact_codes, orphan_codes, unused_codes, passed) from one aggregate over both sides."""
    sides = dim.select(F.col(dim_code).alias("code"), F.lit(1).alias("d"), F.lit(0).alias("f")).unionByName(
        fact.select(F.col(fact_code).alias("code"), F.lit(0).alias("d"), F.lit(1).alias("f"))
    )
    codes = sides.where(F.col("code").isNotNull()).groupBy("code").agg(F.max("d").alias("d"), F.max("f").alias("f"))
    passed = F.col("orphan_codes") == 0
    if expected is not None:
        passed = passed & (F.col("dim_codes") == expected) & (F.col("fact_codes") == expected)
    return codes.agg(
        F.count_if(F.col("d") == 1).alias("dim_codes"),
        F.count_if(F.col("f") == 1).alias("fact_codes"),
        F.count_if((F.col("f") == 1) & (F.col("d") == 0)).alias("orphan_codes"),
        F.count_if((F.col("f") == 0) & (F.col("d") == 1)).alias("unused_codes"),
    ).withColumn("passed", passed)


def row_count(df: DataFrame, dataset: str, expected: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(dataset).alias("dataset"), "rows", (F.col("rows") == expected).alias("passed")
    )


def summary_stats(datasets: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(dataset, column, min, max, mean, median), NULLs skipped, exact, in two passes over each dataset: one for
    everything but the median and for its bracket, one for the median."""
    stats, pairs = [], []
    for dataset, (df, columns) in datasets.items():
        summed = df.agg(
            *(F.min(F.col(c).cast("double")).alias(f"min{i}") for i, c in enumerate(columns)),
            *(F.max(F.col(c).cast("double")).alias(f"max{i}") for i, c in enumerate(columns)),
            *(F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(f"mean{i}") for i, c in enumerate(columns)),
            *(F.count(c).alias(f"rows{i}") for i, c in enumerate(columns)),
            *(bracket(F.col(c).cast("double")).alias(f"ends{i}") for i, c in enumerate(columns)),
        )
        rows = F.array(
            *(F.struct(F.lit(c).alias("column"), *(F.col(f"{n}{i}").alias(n) for n in ("min", "max", "mean", "rows", "ends")))
              for i, c in enumerate(columns))
        )
        stats.append(summed.select(F.lit(dataset).alias("dataset"), F.inline(rows)))
        pairs.append(value_pairs(df, columns, prefix=dataset + "."))
    place = F.concat_ws(".", "dataset", "column")
    found = union_all(stats)
    ranges = found.where("ends IS NOT NULL").select(
        place.alias("column"), "rows", F.col("ends")[0].alias("lo"), F.col("ends")[1].alias("hi")
    )
    medians = exact_medians(union_all(pairs), ranges).withColumnRenamed("column", "_place")
    return found.join(medians, place == F.col("_place"), "left").drop("_place", "rows", "ends")


def profile(df: DataFrame, dataset: str, columns: Sequence[str], rules: Sequence[Rule] = ()) -> DataFrame:
    """Completeness of ``columns`` and validity of ``rules`` as gate rows, from one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)),
        *(F.count_if(rule.broken).alias(f"r{i}") for i, rule in enumerate(rules)),
    )

    def row(check: str, column: str, value: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(dataset).alias("dataset"),
            F.lit(column).alias("column"),
            value.cast("double").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    found = []
    for i, column in enumerate(columns):
        pct = F.try_divide(F.col(f"n{i}") * F.lit(100.0), F.col("_rows"))
        found.append(row("completeness", column, F.round(pct, 2), pct < k.MAX_NULL_PCT))
    for i, rule in enumerate(rules):
        found.append(row("validity", rule.name, F.col(f"r{i}"), F.col(f"r{i}") == 0))
    return counted.select(F.inline(F.array(*found)))


def gate_rows(
    profiled: Sequence[DataFrame] = (),
    consistent: Sequence[DataFrame] = (),
    referential: Sequence[DataFrame] = (),
    unique: Sequence[DataFrame] = (),
    counted: Sequence[DataFrame] = (),
) -> DataFrame:
    """All findings in one shape: (check, dataset, column, value, passed); ``profiled`` has it already."""

    def rows(check, frames, dataset, column, value):
        return [
            f.select(
                F.lit(check).alias("check"),
                dataset.alias("dataset"),
                column.alias("column"),
                value.cast("double").alias("value"),
                "passed",
            )
            for f in frames
        ]

    name = F.col("dataset")
    return union_all(
        list(profiled)
        + rows("consistency", consistent, F.lit("all"), F.lit("year"), F.col("common_year_count"))
        + rows("referential", referential, F.lit("all"), F.lit("code"), F.col("orphan_codes"))
        + rows("uniqueness", unique, name, F.col("grain"), F.col("duplicates"))
        + rows("row_count", counted, name, F.lit("*"), F.col("rows"))
    )


def gate(findings: DataFrame) -> DataFrame:
    """(check, findings, failed, passed) per check and one row 'overall' that needs all of them."""
    summary = findings.withColumn("check", F.explode(F.array("check", F.lit("overall"))))
    return summary.groupBy("check").agg(
        F.count(F.lit(1)).alias("findings"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("passed"),
    )

