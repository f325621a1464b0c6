import collections
import re

import brute
from carbonloom.llm import quality_cascade as qc
from carbonloom.llm import queries


def measured(text):
    words = re.findall(brute.WORD, text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(brute.WORD, x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_distinct_words": len(set(words)),
        "n_repeat_words": len(repeated),
    }


def kept(m):
    n = m["n_words"]
    return not (
        n < 20
        or 100 * m["n_repeat_words"] > 30 * n
        or m["n_symbols"] > n
        or 2 * m["n_dup_lines"] > m["n_lines"]
        or (n >= 30 and 10 * m["n_symbols"] > 4 * n)
        or 4 * m["n_distinct_words"] ** 2 < 9 * n
        or m["word_chars"] < 2 * n
        or m["word_chars"] > 25 * n
    )


def test_measures_and_verdicts(spark, docs, texts):
    more = {1000: "a b c d e f g h i " * 5, 1001: "a b c d e f g h x a b c d e f g h", 1002: " ".join(f"w{i} |" for i in range(40)), 1003: "same line\n" * 30}
    every = dict(texts) | more
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    got = {r.doc_id: r.asDict() for r in qc.verdicts(df).collect()}
    for key, text in every.items():
        want = measured(text)
        assert {c: got[key][c] for c in RETURNED} == {c: want[c] for c in RETURNED}, key
        assert got[key]["kept"] == kept(want)
        assert got[key]["base_failed"] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
    stay = qc.keep(df)
    assert {r.doc_id for r in stay.collect()} == {k for k, t in every.items() if kept(measured(t))}


RETURNED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_every_measure_of_every_row(spark, docs, texts, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.asDict() for r in queries.op10_quality_cascade(spark, str(tmp_path)).collect()}
    for key, text in texts.items():
        want = measured(text)
        assert {c: found[key].get(c) for c in want} == want, key
        assert found[key]["kept"] == kept(want)
    failed = [found[k] for k in texts if found[k]["base_failed"]]
    assert any(r["n_lines"] > 1 and r["n_distinct_words"] > 1 for r in failed)


def test_repeated_rows_and_clashing_names(spark):
    ddl = "doc_id long, text string, n_words string, kept int, _text string, _words long, _lines int, base_failed string, _n int, _1 int, _at int"
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, *[None] * 9), (1, text, *[None] * 9), (1, None, *[None] * 9), (None, "short", *[None] * 9)]
    df = spark.createDataFrame(rows, ddl)
    found = qc.verdicts(df)
    assert found.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted((r.n_words, r.kept) for r in found.collect()) == [(0, False), (1, False), (30, True), (30, True)]
    stay = qc.keep(df)
    assert stay.columns == df.columns and [r.text for r in stay.collect()] == [text, text]


def test_later_measures_are_not_computed_for_failed_rows(spark):
    """The verdict is one CASE: a branch behind the first that holds is not evaluated."""
    plan = qc.verdicts(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.split("\n") if "AS kept" in x)
    case = line[: line.index("AS kept")]
    assert "array_distinct" in case[case.rindex("CASE WHEN") :] and line.count("array_distinct") == plan.count("array_distinct(_words") 


def test_columns_stay(docs, nothing):
    assert qc.keep(docs).columns == docs.columns
    assert qc.keep(nothing).count() == 0 and qc.verdicts(nothing).count() == 0


def test_order_by_rejection_per_cost(docs):
    found = qc.order_rules(docs)
    worth = [x["rejection"] / x["cost"] for x in found]
    assert worth == sorted(worth, reverse=True)
    assert {x["rule"].name for x in found} == {r.name for r in qc.RULES}


def test_native(docs):
    plan = qc.verdicts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
