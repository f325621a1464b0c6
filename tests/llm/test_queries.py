"""The registered queries against SQL or their contracts, on the smallest tables."""

import os
import sys

import brute
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracle import compare, connect  # noqa: E402

from carbonloom.llm import entry  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(brute.SF_DIR), reason="no tables")

COLUMNS = {
    "op1_": {"doc_id", "held_out", "score", "predicted"},
    "op2_": {"page_id", "host", "path", "rule", "verdict"},
    "op3_": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op4_": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op5_": {"doc_id", "n_shingles", "component_id"},
    "op6_": {"doc_id"},
    "op7_": {"doc_id", "round_trip"},
    "op8_": {"doc_id"},
    "op9_": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op10_": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op11_": {"item_id", "rank", "doc_id", "score"},
    "op13_": {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
    "op12_": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
}
NUMBERED = {next(p for p in COLUMNS if n.startswith(p)): n for n in entry.QUERIES if n != "pipeline"}


def test_one_query_for_each_number():
    assert set(NUMBERED) == set(COLUMNS) and len(entry.QUERIES) == len(COLUMNS) + 1


@pytest.mark.parametrize("name", list(entry.ORACLES))
def test_against_sql(spark, name):
    assert not [p for p in compare(spark, connect(brute.SF_DIR), name, brute.SF_DIR) if not p.startswith("(")]


@pytest.mark.parametrize("prefix", list(COLUMNS))
def test_a_row_for_every_row(spark, prefix):
    df = entry.QUERIES[NUMBERED[prefix]](spark, brute.SF_DIR)
    if prefix in ("op11_", "op13_"):  # rows of their own: see their SQL
        assert COLUMNS[prefix] <= set(df.columns)
        return
    table, key = ("pages", "page_id") if prefix == "op2_" else ("documents", "doc_id")
    want = spark.read.parquet(f"{brute.SF_DIR}/{table}.parquet").select(key)
    assert COLUMNS[prefix] <= set(df.columns)
    got = df.select(key).collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in want.collect())
