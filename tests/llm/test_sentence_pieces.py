import os

import pytest
from carbonloom.llm import sentence_pieces as sp
from carbonloom.llm.queries import PIECES

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary")


@pytest.fixture(scope="module")
def vocabulary():
    return sp.read_vocabulary(PIECES)


def best_path(v, text):
    """Plain Viterbi over the whole text."""
    raw = b" " + text.encode()
    ids = {p: i for i, p in enumerate(v.pieces) if v.scores[i]}
    best, back = [0.0] + [float("-inf")] * len(raw), [None] * (len(raw) + 1)
    for s in range(len(raw)):
        if best[s] == float("-inf"):
            continue
        char = 1 if raw[s] < 0xC0 else 2 if raw[s] < 0xE0 else 3 if raw[s] < 0xF0 else 4
        for e in range(s + 1, min(len(raw), s + 48) + 1):
            i = ids.get(raw[s:e])
            if i is not None and best[s] + v.scores[i] > best[e] + sp.TIE:
                best[e], back[e] = best[s] + v.scores[i], (s, [i])
        if raw[s : s + char] not in ids and best[s] + v.unknown > best[s + char] + sp.TIE:
            best[s + char], back[s + char] = best[s] + v.unknown, (s, [int(v.byte_ids[b]) for b in raw[s : s + char]])
    out, at = [], len(raw)
    while at:
        at, some = back[at]
        out = some + out
    return out


ODD = ["▁", " ▁a b▁▁", "  two  spaces ", "\n\n\t", "🙂🙂 ok", "é" * 700, " " * 50 + "x", "\x00\x01", "%%%%%"]


def test_best_path_and_round_trip(spark, docs, texts, vocabulary):
    every = dict(texts) | {1000 + i: t for i, t in enumerate(ODD)}
    df = docs.select("doc_id", "text").union(spark.createDataFrame([(k, t) for k, t in every.items() if k >= 1000], "doc_id long, text string"))
    found = sp.decode(sp.encode(df, vocabulary), vocabulary).collect()
    assert len(found) == len(every)
    assert sorted(map(str, sp.encode(df, vocabulary, decoded="decoded").collect())) == sorted(map(str, found))
    for r in found:
        text = every[r.doc_id]
        assert r.decoded == text
        if text is None:
            assert r.ids is None
        elif len(text) < 3500:
            assert r.ids == (best_path(vocabulary, text) if text else [])


def test_clashing_names_and_empty(docs, nothing, vocabulary):
    encoded = sp.encode(docs, vocabulary)
    assert encoded.columns == ["doc_id", "text", "ids"] and encoded.count() == docs.count()
    assert sp.decode(sp.encode(nothing, vocabulary), vocabulary).count() == 0


def test_decoding_any_ids(vocabulary):
    assert sp.decode_ids(vocabulary, None) is None and sp.decode_ids(vocabulary, []) == ""
    assert sp.decode_ids(vocabulary, [0, 1, 2, 10**9, int(vocabulary.byte_ids[0xFF])]) == "⁇⁇\ufffd"


def test_trie_holds_exactly_its_keys():
    keys = [b"a", b"ab", b"abc", b"b", b" ", b" a", bytes([255, 0])]
    trie = sp.DoubleArray([(k, i) for i, k in enumerate(keys)])

    def find(key):
        state = 0
        for b in key:
            child = int(trie.base[state]) + b + 1
            if trie.check[child] != state:
                return -1
            state = child
        return int(trie.value[state])

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert [find(k) for k in (b"", b"c", b"abcd", b" b", bytes([255]))] == [-1] * 5
