import brute
from carbonloom.llm import leak_scan


def test_hits(spark, docs, texts):
    words = texts[24].split() + texts[3].split()
    items = [
        (1, " ".join(words[:14])), (2, "ONE"), (3, None), (4, " ,. "), (5, texts[4]), (6, " ".join(words[:14]).upper()), (10, "one two!"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(texts, items)
    got = leak_scan.scan(docs, bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
    assert sum(h > 0 for _, h, _ in want.values()) > 3
    for r in got:
        hit = sum(len(brute.leak_words(texts[r.doc_id][s.start : s.end])) for s in r.spans)
        assert hit == r.n_hit
    clean = leak_scan.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {k for k, (_, h, _) in want.items() if not h}
    row = leak_scan.digest(leak_scan.scan(docs, bench)).where("doc_id = 4").first()
    assert row.items_sha256 == brute.sha(",".join(want[4][2])) and row.contaminated


def test_slices_find_the_same(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(leak_scan, "SLICE_BYTES", 200)
    items = [(i, texts[i]) for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in leak_scan.scan(docs, bench).collect()}
    assert got == brute.leaks(texts, items)


def test_empty(spark, docs, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in leak_scan.scan(docs, none).collect()} == {0}
    assert leak_scan.scan(nothing, none).count() == 0
