"""Quality rules as a short-circuit cascade, in built-in functions only.

A rule says when a text fails. The rules' rejection rates and costs are estimated on a sample; the cascade
asks the rule with the highest rejection per cost first and stops at the first that fails, so a costly
measure is computed only for texts that the cheaper rules let through. The verdict does not depend on the
order: a text is kept when no rule fails.

Words are runs without space, tab, line feed, vertical tab, form feed and carriage return. A null text
has no words and fails ``too_short``; an empty table gives an empty result; repeated rows are judged one
by one; other columns of the input are never read, so their names cannot clash.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows of the random sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 2_000


def word_array(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SEPARATORS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")).otherwise(
        F.array().cast("array<string>")
    )


def line_array(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.length(F.btrim(line, F.lit(SEPARATORS))) > 0)


def symbol_count(text: Column) -> Column:
    rest = F.coalesce(text, F.lit(""))
    for symbol in SYMBOLS:
        rest = F.replace(rest, F.lit(symbol), F.lit(""))
    return (F.length(F.coalesce(text, F.lit(""))) - F.length(rest)).cast("long")


def _shifted(array: Column, by: int, size: Column) -> Column:
    return F.slice(array, F.lit(1 + by), F.greatest(size - by, F.lit(0)))


def _pairs(array: Column, by: int, size: Column) -> Column:
    """Hash of every element and the one ``by`` places on; one array of size - by."""
    return F.zip_with(F.slice(array, F.lit(1), F.greatest(size - by, F.lit(0))), _shifted(array, by, size), lambda a, b: F.xxhash64(a, b))


def with_repeats(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds the number of words inside 8-word windows found twice or more in the row.

    Window hashes come from doubling: pairs, fours, eights. A text without a repeated four has no
    repeated eight, and most texts end there. Else the windows are sorted with their places; the union
    of the repeated ones is the sum of the gaps between their places, eight at most, plus the last eight.
    """
    kept = df.columns
    df = df.withColumn("_n", F.size(words)).withColumn("_1", F.transform(words, lambda word: F.xxhash64(word)))
    df = df.withColumn("_2", F.when(F.col("_n") > WINDOW, _pairs(F.col("_1"), 1, F.col("_n"))))
    df = df.withColumn("_4", _pairs(F.col("_2"), 2, F.col("_n") - 1))
    df = df.withColumn("_4", F.when(F.size(F.array_distinct("_4")) < F.size("_4"), F.col("_4")))
    df = df.withColumn("_8", _pairs(F.col("_4"), 4, F.col("_n") - 3))
    df = df.withColumn("_8", F.when(F.size(F.array_distinct("_8")) < F.size("_8"), F.col("_8")))
    df = df.withColumn(
        "_s", F.array_sort(F.transform("_8", lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))
    )
    size = F.size("_s")
    none = F.array().cast("array<int>")
    twice = F.zip_with(
        F.slice("_s", F.lit(1), F.greatest(size - 1, F.lit(0))),
        _shifted(F.col("_s"), 1, size),
        lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)).otherwise(none),
    )
    df = df.withColumn("_p", F.array_sort(F.array_distinct(F.flatten(twice))))
    size = F.size("_p")
    gaps = F.zip_with(
        F.slice("_p", F.lit(1), F.greatest(size - 1, F.lit(0))),
        _shifted(F.col("_p"), 1, size),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda total, gap: total + gap)
    return df.withColumn(out, F.coalesce(F.when(F.size("_p") > 0, covered), F.lit(0).cast("long"))).select(*kept, out)


#: Measures that the method's rules alone ask for, out of the words and lines of a row.
_LATER = {
    "n_lines": lambda: F.size("_lines").cast("long"),
    "n_distinct_words": lambda: F.size(F.array_distinct("_words")).cast("long"),
}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: bool = False) -> DataFrame:
    """doc_id and the measures that are returned for every row, all as long; also _words and _lines for the rest.

    ``every``: those that only the method's rules read are returned, too.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    df = df.withColumn("_words", word_array(F.col("_text"))).withColumn("_lines", line_array(F.col("_text")))
    later = {n: [make().alias(n)] if every else [] for n, make in _LATER.items()}
    df = df.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        symbol_count(F.col("_text")).alias("n_symbols"),
        *later["n_lines"],
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        *later["n_distinct_words"],
        "_words",
        "_lines",
    )
    return with_repeats(df, "_words", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` takes the measures as columns; ``needs`` names those it reads."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[[Mapping[str, Column]], Column]


BASE_RULES = (
    Rule("too_short", ("n_words",), lambda m: m["n_words"] < 20),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
)
METHOD_RULES = (
    Rule("symbols", ("n_words", "n_symbols"), lambda m: m["n_symbols"] > m["n_words"]),
    Rule("dup_lines", ("n_lines", "n_dup_lines"), lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("tabular", ("n_words", "n_symbols"), lambda m: (m["n_words"] >= 30) & (10 * m["n_symbols"] > 4 * m["n_words"])),
    Rule("few_words", ("n_words", "n_distinct_words"), lambda m: 4 * m["n_distinct_words"] * m["n_distinct_words"] < 9 * m["n_words"]),
    Rule("word_length", ("n_words", "word_chars"), lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"])),
)
RULES = (*BASE_RULES, *METHOD_RULES)


def _measure_steps() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """How each measure is added to a frame with _text; words and lines are made once, by name."""

    def words(df):
        return df if "_words" in df.columns else df.withColumn("_words", word_array(F.col("_text")))

    def lines(df):
        return df if "_lines" in df.columns else df.withColumn("_lines", line_array(F.col("_text")))

    return {
        "n_words": lambda df: words(df).withColumn("n_words", F.size("_words").cast("long")),
        "word_chars": lambda df: words(df).withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long")),
        "n_symbols": lambda df: df.withColumn("n_symbols", symbol_count(F.col("_text"))),
        "n_lines": lambda df: lines(df).withColumn("n_lines", F.size("_lines").cast("long")),
        "n_dup_lines": lambda df: lines(df).withColumn(
            "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")
        ),
        "n_distinct_words": lambda df: words(df).withColumn("n_distinct_words", F.size(F.array_distinct("_words")).cast("long")),
        "n_repeat_words": lambda df: with_repeats(words(df), "_words", "n_repeat_words"),
    }


def _seconds(df: DataFrame, fails: Column) -> tuple[int, float]:
    """Rows that fail, and the least time of three runs."""
    times = []
    for _ in range(3):
        began = time.perf_counter()
        rejected = df.agg(F.count_if(fails).alias("n")).first().n
        times.append(time.perf_counter() - began)
    return rejected, min(times)


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules with the rejection rate and cost seen on ``rows`` random rows of the whole table, highest rejection per cost first.

    Cost is the time of the measures a rule needs over the sample held in memory, less that of a rule without any: starting a
    job takes longer than a cheap rule. An empty table keeps the given order. Ties (and rules that reject nothing) go by
    cost, then by place.
    """
    sample = docs.select(F.col(text_col).alias("_text"), F.rand(7).alias("_at")).orderBy("_at").limit(rows).select("_text").persist()
    try:
        total = sample.count()
        _, start = _seconds(sample, F.col("_text").isNull()) if total else (0, 0.0)
        steps, found = _measure_steps(), []
        for place, rule in enumerate(rules):
            df = sample
            for name in rule.needs:
                df = steps[name](df)
            fails = F.coalesce(rule.fails({n: F.col(n) for n in rule.needs}), F.lit(False))
            rejected, seconds = _seconds(df, fails) if total else (0, 0.0)
            cost = max(seconds - start, 1e-4)
            found.append({"rule": rule, "rejection": rejected / total if total else 0.0, "cost": cost, "place": place})
    finally:
        sample.unpersist()
    if not total:
        return found
    return sorted(found, key=lambda x: (-x["rejection"] / x["cost"], x["cost"], x["place"]))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they were.

    Every rule of the ordered cascade is a filter of its own: a measure that only later rules need is
    computed after the filters before it, for the rows that are left.
    """
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    df = docs.toDF(*names.values()).withColumn("_text", F.col(names[text_col]))
    steps, has = _measure_steps(), set()
    for found in order_rules(docs, rules, text_col, rows):
        rule = found["rule"]
        for name in rule.needs:
            if name not in has:
                # generated, not projected: else Catalyst would write the measure out in the filter, term by term
                df, has = steps[name](df), has | {name}
                df = df.select(*(c for c in df.columns if c != name), F.explode(F.array(name)).alias(name))
        df = df.filter(~F.coalesce(rule.fails({n: F.col(n) for n in rule.needs}), F.lit(False)))
    return df.select(*(F.col(new).alias(old) for old, new in names.items()))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, every: bool = False) -> DataFrame:
    """One row per document: the measures of the contract, ``base_failed`` and ``kept``.

    The measures that are returned are computed for every row; with ``every`` these are all that any rule reads. Else those
    that only the method's rules read are branches of the verdict: the rules stand in the cascade's order in one CASE, whose
    branches after the first that holds are not evaluated, and none is for a row that has failed the base rules.
    """
    df = measures(docs, id_col, text_col, every)
    has = {c: F.col(c) for c in df.columns if not c.startswith("_") and c != "doc_id"}
    df = df.withColumn("base_failed", BASE_RULES[0].fails(has) | BASE_RULES[1].fails(has))
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for found in order_rules(docs, METHOD_RULES, text_col, rows):
        rule = found["rule"]
        known = {n: has[n] if n in has else _LATER[n]() for n in rule.needs}
        verdict = verdict.when(F.coalesce(rule.fails(known), F.lit(False)), F.lit(False))
    return df.withColumn("kept", verdict.otherwise(F.lit(True))).drop("_words", "_lines")
