import tracemalloc

import brute
import pyarrow as pa
from carbonloom.llm import hashing, ngram_join


def test_components(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    sets = {k: brute.shingles(t) for k, t in texts.items()}
    comps = brute.linked(sets)
    assert got == {k: (len(sets[k]), comps[k]) for k in texts}
    assert sum(k != c for k, c in comps.items()) > 20


def test_one_of_each_group_stays(docs, texts):
    comps = brute.linked({k: brute.shingles(t) for k, t in texts.items()})
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, c in comps.items() if k == c)


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(7, text), (7, text), (None, text), (9, text + " i"), (None, None)], "doc_id long, text string")
    got = sorted(ngram_join.join(df).collect(), key=str)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(7, 7), (7, 7), (9, 7)]
    assert {r.component_id for r in got if r.doc_id is None} == {7, None}
    assert [r.doc_id for r in ngram_join.keep_one(df).collect() if r.doc_id] == [7]


def test_many_near_copies_of_one_text(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words))]
    for i in range(1, 200):
        near = list(words)
        near[i % 60] = f"x{i}"
        rows.append((i, " ".join(near)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join(df).collect()}
    assert got == brute.linked({k: brute.shingles(t) for k, t in rows})


def test_empty(nothing):
    assert ngram_join.join(nothing).count() == 0
    assert ngram_join.keep_one(nothing).count() == 0


def test_null_ids_in_the_chunk_of_the_smallest_id(spark):
    text, other = "a b c d e f g h", "q r s t u v w x"
    rows = [(7, text), (None, text), (9, text + " i"), (None, other), (12, other + " y"), (None, "k l m n o p"), (None, "k l m n o p")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # null ids: a copy of 7, a text of its own that is near 12, and two rows that are alone
    want = [(7, 7), (9, 7), (12, 12), (None, 7), (None, 12), (None, None), (None, None)]
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(want, key=str)


def test_chunks_of_few_words():
    for text in ("", "one", "one two", "one two three", "one two three four"):
        hashes, of = hashing.grams(*hashing.words(pa.chunked_array([[text]], pa.string())), 5)
        assert of.tolist() == [0] * bool(text) and len(hashes) == bool(text)


def test_rows_of_one_id_with_different_texts(spark):
    """Each row stands for its own text: a row alike to nothing stays, whatever other rows its id has."""
    a, b = "k l m n o p q r", "a b c d e f g h"
    rows = [(3, b), (7, a), (7, b + " i"), (3, b), (None, a + " s"), (5, None), (5, None), (5, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()), key=str)
    want = [(3, 4, 3), (3, 4, 3), (7, 4, 7), (7, 5, 3), (None, 5, 7), (5, 0, 5), (5, 0, 5), (5, 1, 5)]
    assert got == sorted(want, key=str)
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()), key=str)
    assert kept == sorted([(3, b), (7, a), (5, None), (5, "one")], key=str)


def test_sets_take_a_piece_of_the_texts_at_a_time(monkeypatch, texts):
    column = pa.chunked_array([list(texts.values())], pa.string())
    hashes, sizes = ngram_join._sets(column, 5)
    assert sizes.tolist() == [len(brute.shingles(t)) for t in texts.values()]
    monkeypatch.setattr(hashing.pieces, "__defaults__", (300,))
    again, of_each = ngram_join._sets(column, 5)
    assert hashes.tolist() == again.tolist() and sizes.tolist() == of_each.tolist()


def test_sets_of_a_chunk_take_little_memory():
    """Words and repeated shingles of all texts at once took over 50 bytes for each shingle."""
    text = " ".join(f"{i * 7919 % 100_003:x}" for i in range(400))
    column = pa.chunked_array([[f"{i} {text}" for i in range(2000)]], pa.string())
    ngram_join._sets(column.slice(0, 1), 5)  # tables of powers
    tracemalloc.start()
    try:
        hashes, _ = ngram_join._sets(column, 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 35 * len(hashes)


def test_components_of_sets_ordered_in_many_runs(docs, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "_TOKENS", 60)
    monkeypatch.setattr(ngram_join.ch, "chunk_count", lambda docs: 2)
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()}
    assert got == brute.linked({k: brute.shingles(t) for k, t in texts.items()})
