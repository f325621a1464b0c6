"""Repeated rows and columns of clashing names, for operators whose own tests have none, and for the pipeline."""

import os
import random

import brute
import corpus_pipeline
import pytest
from carbonloom.llm import katz, leak_scan, sentence_pieces
from carbonloom.llm.queries import PIECES
from conftest import CLASHES
from pyspark.sql import functions as F

WITH_PIECES = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary")
TEXTS = {1: "a b c a b", 2: None, 3: "", 4: "é ñ a b c d e f g h i j k", 5: "a b c a b"}


@pytest.fixture(scope="module")
def repeated(spark):
    rows = [(k, t, *[None] * 12) for k, t in TEXTS.items()]
    return spark.createDataFrame(rows * 3 + [(1, "another text of id one", *[None] * 12)], f"doc_id long, text string, {CLASHES}").repartition(4)


def test_katz_counts_every_row(repeated):
    got = katz.score(repeated, F.col("doc_id") > 0).collect()
    assert len(got) == 3 * len(TEXTS) + 1 and len({(r.doc_id, r.n_tokens, r.score) for r in got}) == len(TEXTS) + 1
    assert {r.train_tokens for r in got} == {3 * (6 + 1 + 1 + 14 + 6) + 6}


def test_leak_scan_judges_every_row(spark, repeated):
    items = [(7, "c d e"), (7, "c d e"), (8, None), (9, "a b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in leak_scan.scan(repeated, bench).collect())
    want = [(k, n, hit, tuple(found)) for k, (n, hit, found) in brute.leaks(TEXTS, items).items()] * 3
    other = brute.leaks({1: "another text of id one"}, items)[1]
    assert got == sorted([*want, (1, other[0], other[1], tuple(other[2]))])
    kept = leak_scan.keep_clean(repeated, bench)
    assert kept.columns == repeated.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 2, 3, 3, 3]


@WITH_PIECES
def test_pieces_of_every_row(repeated):
    v = sentence_pieces.read_vocabulary(PIECES)
    got = sentence_pieces.encode(repeated.select("doc_id", "text"), v, decoded="decoded").collect()
    assert len(got) == 3 * len(TEXTS) + 1
    assert all((r.text or "") == (r.decoded or "") for r in got)
    assert len({(r.text, tuple(r.ids or ())) for r in got}) == len(set(TEXTS.values())) + 1


@WITH_PIECES
def test_pipeline_with_repeated_rows_and_clashing_columns(spark, tmp_path):
    rng = random.Random(2)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    texts = [prose(60) + ".\n" + prose(40) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += rows[:4] + [(3, prose(80)), (None, prose(70)), (50, None)]
    names = [c.split()[0] for c in CLASHES.split(", ")]
    df = spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], f"doc_id long, text string, {CLASHES}")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, texts[5][:90]), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == df.columns and out.dtypes == df.dtypes, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
    # of repeated rows one stays, also of an id with two texts both; the leaked and the null text go
    assert ids == sorted([(False, i) for i in range(12) if i != 5] + [(False, 3), (True, 0)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(ids)
