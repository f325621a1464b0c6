"""Quality checks with injected nulls, duplicates and orphans."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from carbonloom.operators import constraints, quality
from carbonloom.operators.quantiles import exact_medians, value_pairs
from helpers import by_key


def test_completeness_threshold(rows):
    df = rows("a int, b int, c int", *((i, None if i == 0 else i, None if i < 1 else 1) for i in range(20)))
    found = by_key(quality.completeness(df, "d", ["a", "b", "c"]), "column")
    assert found["a"]["passed"] and found["a"]["null_count"] == 0
    assert not found["b"]["passed"] and found["b"]["null_pct"] == 5.0
    assert not by_key(quality.completeness(df.where("false"), "d", ["a"]), "column")["a"]["passed"]


def test_uniqueness_counts_rows_beyond_the_first(rows):
    df = rows("a int, b string", (1, "x"), (1, "x"), (1, "x"), (2, None), (2, None), (3, "y"))
    found = quality.uniqueness(df, "d", ["a", "b"]).first()
    assert found.duplicates == 3 and not found.passed
    assert quality.uniqueness(df.where("false"), "d", ["a"]).first().passed


def test_years(rows):
    one = rows("y int", *((y,) for y in range(1990, 2024)))
    two = rows("y int", *((y,) for y in [*range(2015, 2025), None]))
    coverage = quality.year_coverage({"a": (one, F.col("y")), "b": (two, F.col("y"))})
    assert sorted(r.year for r in quality.common_years(coverage).collect()) == list(range(2015, 2024))
    found = quality.year_consistency(coverage).first()
    assert (found.first_a, found.last_a, found.first_b, found.last_b) == (1990, 2023, 2015, 2024)
    assert found.common_year_count == 9 and found.passed
    assert not quality.year_consistency(coverage, (2015, 2024)).first().passed
    assert not quality.year_consistency(coverage, at_least=10).first().passed


def test_reference_counts(rows):
    dim = rows("code string", ("01",), ("02",), ("03",))
    fact = rows("code string", ("01",), ("01",), ("09",), (None,))
    found = quality.reference_counts(fact, "code", dim, "code", 3).first()
    assert tuple(found) == (3, 2, 1, 2, False)
    assert quality.reference_counts(dim, "code", dim, "code", 3).first().passed
    assert not quality.reference_counts(dim, "code", dim, "code", 63).first().passed


def test_rules_and_null_handling(rows):
    df = rows("v double", (1.0,), (0.0,), (-1.0,), (101.0,), (None,))
    found = by_key(
        constraints.violations(
            df, "d",
            [constraints.non_negative("v"), constraints.positive("v", null_ok=False), constraints.percentage("v"),
             constraints.required("v")],
        ),
        "rule",
    )
    assert {name: r["violations"] for name, r in found.items()} == {
        "v >= 0": 1, "v > 0": 3, "v in 0..100": 2, "v not null": 1
    }
    with pytest.raises(ValueError, match="v not null: 1 rows"):
        constraints.enforce(df, "d", [constraints.required("v")])
    constraints.enforce(df, "d", [constraints.Rule("any", "true")])
    valid, broken = constraints.quarantine(df, [constraints.non_negative("v"), constraints.required("v")])
    assert valid.count() == 3 and sorted(r.broken_rules[0] for r in broken.collect()) == ["v >= 0", "v not null"]
    assert constraints.fail_on_broken(valid, "d", [constraints.required("v")]).count() == 3
    with pytest.raises(Exception, match="broken rules: v >= 0"):
        constraints.fail_on_broken(df, "d", [constraints.non_negative("v")]).collect()


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_exact_medians(spark, seed):
    rng = random.Random(seed)
    columns = {
        "uniform": [rng.uniform(-5, 5) for _ in range(501)],
        "skewed": [rng.lognormvariate(0, 6) for _ in range(501)],
        "hot": [7.0 if rng.random() < 0.4 else rng.gauss(0, 1) for _ in range(501)],
        "constant": [3.0] * 501,
        "scales": [rng.choice([rng.random(), rng.random(), 1e8 * rng.random(), 1e15, -1e12]) for _ in range(501)],
        "holes": [None if i % 2 else float(i) for i in range(501)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    found = {r["column"]: r["median"] for r in exact_medians(value_pairs(df, list(columns))).collect()}
    for name, values in columns.items():
        assert found[name] == statistics.median(v for v in values if v is not None)


def test_even_count_averages_the_middle(rows):
    df = rows("v int", (1,), (2,), (10,), (20,))
    assert exact_medians(value_pairs(df, ["v"])).first()["median"] == 6.0


def test_summary(rows):
    df = rows("v double, w double", (1.0, None), (3.0, None), (None, None))
    found = quality.summary_stats({"d": (df, ["v", "w"])})
    by = by_key(found, "column")
    assert by["v"] == {"dataset": "d", "column": "v", "min": 1.0, "max": 3.0, "mean": 2.0, "median": 2.0}
    assert by["w"]["median"] is None and by["w"]["mean"] is None


def test_gate(rows):
    df = rows("a int", (1,), (1,))
    findings = quality.gate_rows(
        profiled=[quality.profile(df, "d", ["a"], [constraints.positive("a"), constraints.Rule("a < 1", "a < 1")])],
        unique=[quality.uniqueness(df, "d", ["a"])],
        counted=[quality.row_count(df, "d", 2)],
    )
    found = by_key(quality.gate(findings), "check")
    assert found["completeness"]["passed"] and found["row_count"]["passed"]
    assert not found["uniqueness"]["passed"] and not found["overall"]["passed"]
    assert found["validity"]["findings"] == 2 and found["validity"]["failed"] == 1
    assert found["overall"]["findings"] == 5 and found["overall"]["failed"] == 2
    nothing = by_key(quality.gate(quality.profile(df.where("false"), "d", ["a"])), "check")
    assert not nothing["completeness"]["passed"]
