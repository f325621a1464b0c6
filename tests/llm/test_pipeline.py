"""The stages in turn against plain restatements, on a small fixture."""

import os
import random

import brute
import corpus_pipeline
import pytest
from test_quality_cascade import kept, measured

from carbonloom.llm.queries import PIECES

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def corpus():
    rng = random.Random(11)
    texts = ["\n".join(prose(rng, 30) + "." for _ in range(3)) for _ in range(30)]
    texts += texts[:4]  # exact copies lose all their lines
    for text in texts[4:8]:  # near copies: a word of each line changed
        texts.append("\n".join(line.replace(line.split()[3], "changed", 1) for line in text.split("\n")))
    near = prose(rng, 200).split()
    for i in range(3):  # one long line each, too different as lines of characters, alike as documents
        texts.append(" ".join(near[:100]) + "\n" + " ".join(w if j % 60 else f"x{i}{j}" for j, w in enumerate(near[100:])))
    bench = prose(rng, 14)
    texts += [prose(rng, 20) + "\n" + bench + "\n" + prose(rng, 20), "too short", None, "", "same line\n" * 40]
    return dict(enumerate(texts)), [(1, bench), (2, prose(rng, 14)), (3, None)]


def test_stages(spark, tmp_path):
    texts, items = corpus()
    rows = [(k, t, "en", f"s{k % 2}", len(t or "")) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    first = {k: t for k, t in texts.items() if kept(measured(t))}
    unique = brute.deduplicated(first)
    second = {k: t for k, t in unique.items() if brute.lines(t)}
    comps = brute.linked({k: brute.shingles(t) for k, t in second.items()})
    third = {k: t for k, t in second.items() if comps[k] == k}
    fourth = {k: t for k, t in third.items() if not brute.leaks({k: t}, items)[k][1]}
    assert len(texts) > len(first) > len(second) and len(third) > len(fourth) > 25

    for (name, stage), want in zip(corpus_pipeline.STAGES, (first, second, third, fourth, fourth)):
        out = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            got = out.collect()
            assert {r.doc_id: r.text for r in got} == want, name
            assert all(r.n_chars == len(r.text) and r.source == f"s{r.doc_id % 2}" for r in got)
        else:
            got = out.collect()
            assert {r.doc_id for r in got} == set(want) and all(r.round_trip and r.n_pieces == len(r.ids) for r in got)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(whole) == sorted(got)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
