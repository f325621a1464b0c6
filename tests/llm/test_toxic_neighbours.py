import collections
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest
from carbonloom.llm import toxic_neighbours as tn

import brute


def test_index_is_exact():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 700):
        dense = rng.random((n, 40)) * (rng.random((n, 40)) < 0.15)
        dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
        vectors = [(np.flatnonzero(v), v[v > 0]) for v in dense]
        index = tn.BlockMaxIndex(vectors, 40, block=16)
        for _ in range(30):
            q = rng.random(40) * (rng.random(40) < 0.2)
            q /= max(np.linalg.norm(q), 1e-12)
            near, cosines = index.nearest(np.flatnonzero(q), q[q > 0], 7)
            want = np.sort(dense @ q)[::-1]
            want = want[want > 0][:7]
            assert cosines == pytest.approx(want)
            assert cosines == pytest.approx((dense @ q)[near])


def test_ties_go_to_the_first():
    same = (np.array([0, 1]), np.array([0.6, 0.8]))
    near, cosines = tn.BlockMaxIndex([same] * 200, 2).nearest(*same, 5)
    assert near.tolist() == [0, 1, 2, 3, 4] and cosines == pytest.approx([1] * 5)


def test_learns_and_answers_for_all_rows(spark, docs, texts):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(60)]
        if i % 4 == 0:
            words[rng.randrange(60)] = "vileword"
        rows.append((i, " ".join(words), i % 4 == 0))
    some = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(a, int(c)) for a, _, c in rows[:300]] * 2 + [(5, None)], "doc_id long, toxic int")
    model = tn.fit(some, labels)
    got = {r.doc_id: r for r in tn.score(some, model).collect()}
    assert all(got[a].predicted == c for a, _, c in rows[300:])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert got[396].evidence[0].label == 1
    # nulls, empties, long texts and clashing names
    found = {r.doc_id: r for r in tn.score(docs, model).collect()}
    assert set(found) == set(texts)
    assert found[[k for k, t in texts.items() if t is None][0]].score == pytest.approx(model.none_rate)


def test_without_labels(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tn.score(docs, tn.fit(docs, none)).collect()} == {0.0}
    assert tn.score(nothing, tn.fit(nothing, none)).count() == 0


def test_held_out_accuracy(spark):
    from carbonloom.llm.queries import op1_toxic_neighbours

    folder = brute.SF_DIR.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = op1_toxic_neighbours(spark, folder).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in found) / len(found) > 0.93


def test_small_tables_use_every_term(spark):
    # too few examples for any term to go with the label for sure
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl", "mn"]) for _ in range(rng.randrange(1, 6)))) for i in range(24)]
    docs = spark.createDataFrame([*rows, (50, "zz"), (51, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id long, toxic int")
    model = tn.fit(docs, labels)
    got = {r.doc_id: r for r in tn.score(docs, model, evidence=24).collect()}

    def full(text):
        out = {}
        for t in tn.tokens(text):
            out[t] = out.get(t, 0) + model.weight[model.terms.terms[t]] if t in model.terms.terms else 0
        length = sum(x * x for x in out.values()) ** 0.5
        return {t: x / length for t, x in out.items() if x}

    texts = dict(rows)
    own = {int(i): full(texts[int(i)]) for i in model.example_ids}
    assert len(own) == len({texts[i] for i in range(16)})
    for i, text in rows:
        q = full(text)
        want = sorted((c for o in own.values() if (c := sum(q[t] * o.get(t, 0) for t in q)) > 0), reverse=True)[: model.k]
        assert [e.cosine for e in got[i].evidence] == pytest.approx(want)
        assert want
    assert not got[50].evidence and not got[51].evidence


def test_a_text_stored_several_times_is_one_example(spark):
    rng = random.Random(8)
    texts = {i: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(12)) for i in range(20)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()] * 5 + [(3, "another text of the same id")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, toxic int")
    model = tn.fit(docs, labels, max_examples=20)
    assert model.index.n <= 20 and len(set(model.example_ids)) >= 19
    every = tn.fit(docs, labels, max_examples=100)
    assert every.index.n == 21


def test_terms_are_found_by_hash_in_the_tasks(texts, monkeypatch):
    monkeypatch.setattr(tn.hs, "PIECE", 2000)  # several pieces, and texts longer than one
    monkeypatch.setattr(tn.hs.pieces, "__defaults__", (2000,))
    some = [*texts.values(), "abcd abcde abcdefg", "ABCD ^abcd", "a" * 4 + " " + "a" * 6 + " " + "a" * 7, None]
    every = [[t for w in tn.tokens(text) for t in tn.terms_of(w)] for text in some]
    terms = sorted({t for own in every for t in own})[::2]  # every other term is not in the index
    sent = pickle.loads(pickle.dumps(tn.Vocabulary(pa.array(terms, pa.binary()))))
    assert sent.list is None and len(sent) == len(terms)  # hashes alone are sent
    text, place, n = sent.counts(pa.chunked_array([["left out"], some]).combine_chunks().slice(1))
    got = collections.defaultdict(dict)
    for a, b, c in zip(text.tolist(), place.tolist(), n.tolist()):
        got[a][terms[b]] = c
    known = set(terms)
    assert [got[i] for i in range(len(some))] == [collections.Counter(t for t in own if t in known) for own in every]
    assert list(zip(text, place)) == sorted(zip(text, place))
    assert len(tn.Vocabulary(pa.array([], pa.binary())).counts(pa.array(some))[0]) == 0


def test_frequent_and_rare_terms_together():
    rng = np.random.default_rng(5)
    chance = np.minimum(5 / np.arange(1, 3001), 0.6)  # a few terms in most examples, most in one or two
    dense = rng.random((900, 3000)) * (rng.random((900, 3000)) < chance)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    vectors = [(np.flatnonzero(v), v[v > 0]) for v in dense]
    index = tn.BlockMaxIndex(vectors, 3000)
    for (near, cosines), q in zip(index.nearest_of(vectors[:100], 15), dense):
        every = dense @ q
        assert cosines == pytest.approx(np.sort(every)[::-1][:15], abs=1e-12)
        assert cosines == pytest.approx(every[near], abs=1e-12)
    assert 0 < len(index.hot) < 3000
