import random

import brute
import pytest
from carbonloom.llm import suffix_merge as sm


@pytest.mark.parametrize("hot", [sm.HOT, 1])
def test_exact(docs, texts, hot):
    want = brute.without_repeats(texts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sm.remove_repeats(docs, hot=hot).collect()}
    assert got == want
    assert sum(n > 0 for _, n, _, _ in want.values()) > 15


def test_repeated_ids_and_empty(spark, nothing):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(400))
    df = spark.createDataFrame([(1, text), (1, text), (None, text[50:250]), (0, None)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in sm.remove_repeats(df).collect())
    # the null id comes first, then the two rows in turn
    assert got == [(False, 0, 0), (True, 0, 0), (True, 1, 200), (True, 1, 400)]
    assert sm.remove_repeats(nothing).count() == 0


def test_merge_orders_and_keeps_prefixes():
    rng = random.Random(1)
    for k in (1, 2, 3, 5, 8):
        runs = []
        for _ in range(k):
            strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(0, 30)))
            shared, rests, lengths = sm.front_code(strings)
            assert sm.front_decode(shared, rests, lengths) == strings
            runs.append((strings, shared.tolist()))
        order, prefix = sm.merge(runs)
        out = [runs[r][0][p] for r, p in order]
        assert out == sorted(s for run, _ in runs for s in run)
        assert prefix == [0] * bool(out) + [sm.common(a, b, 0) for a, b in zip(out, out[1:])]
