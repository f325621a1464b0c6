import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import fold
from carbonloom.llm import ranked_search
from conftest import CLASHES

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ranking(docs, items, k=50):
    """{(item, text): [(doc_id, score)]} of rows (doc_id, text) and of (item, text)."""
    rows = [(i, re.findall(TERM, fold(t))) for i, t in docs]
    n_docs, length = sum(bool(w) for _, w in rows), sum(len(w) for _, w in rows)
    df = Counter(t for _, w in rows for t in set(w))
    out = {}
    for item, text in set(items):
        scores = []
        for i, words in rows:
            tf = Counter(words)
            total = 0
            for t in set(re.findall(TERM, fold(text))) & set(tf):
                m = 100 - 50 + 50 * len(words) * n_docs // length
                total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
            if total > 0:
                scores.append((-total, i is None, i or 0))
        if scores:
            out[item, text] = [(None if none else i, -s) for s, none, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.rank):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


def words(rng, n):
    return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.choice([1, 1, 2, 3]) for _ in range(n))


ODD = [None, "", " .,-", "A", "a", "Éa éa", "日本 a_b`c", "z" * 5000, "a " * 3000]


@pytest.mark.parametrize("small", [False, True])
def test_ranks(spark, monkeypatch, small):
    if small:  # many trees with many nodes, items in many groups
        for name, value in (("TREE_DOCS", 40), ("TREE_ENTRIES", 150), ("LEAF", 2), ("ITEM_BYTES", 40)):
            monkeypatch.setattr(ranked_search, name, value)
    rng = random.Random(4)
    texts = ODD + [words(rng, rng.choice([1, 2, 5, 20, 60])) for _ in range(250)]
    texts += texts[:60] + [texts[30]] * 90  # repeats and ties
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, "a b c"), (7, "a b c"), (None, "a b c")]
    items = [(i, words(rng, 6)) for i in range(12)] + [(20, None), (21, ""), (22, "?!"), (23, "unseen"), (24, "A a"), (25, "é 日本 zz"), (25, "é 日本 zz"), (None, "c d")]
    docs = spark.createDataFrame([(*r, *[None] * 12) for r in rows], f"doc_id long, text string, {CLASHES}").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {item: ranks for (item, _), ranks in ranking(rows, items).items()}
    assert found(ranked_search.search(docs, bench)) == want
    assert found(ranked_search.search(docs, bench, k=3)) == {i: r[:3] for i, r in want.items()}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id string, text string")
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    got = ranked_search.search(docs, items)  # an id keeps its type
    assert got.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_two_texts_of_one_item_rank_apart(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (1, "b")], "item_id long, text string")
    assert sorted((r.item_id, r.rank, r.doc_id) for r in ranked_search.search(docs, items).collect()) == [(1, 1, 1), (1, 1, 2)]


def test_bounds_spare_leaves():
    """With rare terms in few documents, most leaves are never read; the best are found all the same."""
    rng = np.random.default_rng(1)
    n, n_terms = 4000, 60
    lists = [np.unique(np.concatenate((rng.integers(0, 10, 6), [59] if i % 500 == 0 else rng.integers(10, 59, 1)))) for i in range(n)]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    ranks, m = np.concatenate(lists), rng.integers(60, 300, n)
    tfs = rng.integers(1, 5, len(ranks))
    tree = ranked_search.Tree(pa.array(np.arange(n)), m, offsets, ranks, tfs, n_terms)
    assert (tree.last - tree.first)[tree.leaf].max() <= ranked_search.LEAF and sorted(tree.first[tree.leaf])[0] == 0
    query, weights = np.array([0, 3, 59]), np.array([10, 20, 5000])
    best = ranked_search.Best(5)
    read = tree.search(query, weights, best, np.zeros(n_terms, np.int64))
    w = dict(zip(query.tolist(), weights.tolist()))
    scores = [
        sum(w.get(r, 0) * (10**9 * t // (1000 * t + 20 * int(m[i]))) for r, t in zip(ranks[a:b].tolist(), tfs[a:b].tolist()))
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:]))
    ]
    want = sorted(range(n), key=lambda i: (-scores[i], i))[:5]
    assert best.ids.to_pylist() == want and best.scores.tolist() == [scores[i] for i in want]
    assert read * 3 < tree.leaf.sum()
