"""Row rules: counting, enforcing and splitting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """``condition`` (an SQL expression) must hold; ``null_ok`` says whether a NULL condition passes."""

    name: str
    condition: str
    null_ok: bool = True

    @property
    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(self.null_ok))


def non_negative(column: str, null_ok: bool = True) -> Rule:
    return Rule(f"{column} >= 0", f"`{column}` >= 0", null_ok)


def positive(column: str, null_ok: bool = True) -> Rule:
    return Rule(f"{column} > 0", f"`{column}` > 0", null_ok)


def percentage(column: str, null_ok: bool = True) -> Rule:
    return Rule(f"{column} in 0..100", f"`{column}` BETWEEN 0 AND 100", null_ok)


def required(column: str) -> Rule:
    return Rule(f"{column} not null", f"`{column}` IS NOT NULL", False)


def violations(df: DataFrame, dataset: str, rules: list[Rule]) -> DataFrame:
    """(dataset, rule, violations, passed) from one pass over ``df``."""
    counted = df.agg(*(F.count_if(rule.broken).alias(f"r{i}") for i, rule in enumerate(rules)))
    rows = F.array(
        *(F.struct(F.lit(rule.name).alias("rule"), F.col(f"r{i}").alias("violations"))
          for i, rule in enumerate(rules))
    )
    return counted.select(F.lit(dataset).alias("dataset"), F.inline(rows)).withColumn(
        "passed", F.col("violations") == 0
    )


def enforce(df: DataFrame, dataset: str, rules: list[Rule]) -> None:
    """Raise if any rule is broken; one aggregate row comes back to the driver."""
    broken = violations(df, dataset, rules).where(~F.col("passed")).collect()
    if broken:
        raise ValueError(
            f"{dataset}: " + "; ".join(f"{row['rule']}: {row['violations']} rows" for row in broken)
        )


def enforce_unique(df: DataFrame, dataset: str, key: list[str], partition: str | None = None) -> set:
    """Raise if two rows share a key; one row comes back to the driver, with the values of ``partition`` (few)."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(
        F.count_if(F.col("n") > 1).alias("doubled"),
        F.min(F.when(F.col("n") > 1, F.struct(*key).cast("string"))).alias("example"),
        *([] if partition is None else [F.collect_set(partition).alias("values")]),
    ).first()
    if found.doubled:
        raise ValueError(f"{dataset}: {found.doubled} values of {', '.join(key)} occur more than once, such as {found.example}")
    return set() if partition is None else set(found["values"])


def fail_on_broken(df: DataFrame, dataset: str, rules: list[Rule]) -> DataFrame:
    """The rows unchanged; the job that reads them fails at the first one that breaks a rule."""
    names = F.concat_ws(", ", *(F.when(rule.broken, F.lit(rule.name)) for rule in rules))
    message = F.concat(F.lit(f"{dataset}: broken rules: "), names)
    broken = F.lit(False)
    for rule in rules:
        broken = broken | rule.broken
    return df.where(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, broken rows with the list of broken rules)."""
    broken = F.filter(
        F.array(*(F.when(rule.broken, F.lit(rule.name)) for rule in rules)), lambda name: name.isNotNull()
    )
    marked = df.withColumn("broken_rules", broken)
    return (
        marked.where(F.size("broken_rules") == 0).drop("broken_rules"),
        marked.where(F.size("broken_rules") > 0),
    )
