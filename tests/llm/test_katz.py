import collections
import math
import re
import time
import zlib

import brute
import pytest
from carbonloom.llm import katz
from pyspark.sql import functions as F


def model(tokens, known):
    """log10 P(w | h) as the docstring states it."""
    one, two = collections.Counter(), collections.Counter()
    for key in known:
        one.update(tokens[key])
        two.update(zip(["<s> ", *tokens[key]], tokens[key]))
    n = sum(one.values())
    d1, d2 = (katz.discounts([sum(c == r for c in of.values()) for r in range(1, 7)]) for of in (one, two))
    held = sum((1 - d1[min(c, 6)]) * c for c in one.values())
    size = n if held > 0 else n + 1
    unknown = held / size if held > 0 else 1 / size

    def word(w):
        return d1[min(one[w], 6)] * one[w] / size if one[w] else unknown

    count, mass, seen = collections.Counter(), collections.Counter(), collections.Counter()
    for (h, w), c in two.items():
        count[h] += c
        mass[h] += d2[min(c, 6)] * c
        seen[h] += word(w)

    def p(h, w):
        if not count[h]:
            return word(w)
        total = count[h] if count[h] - mass[h] > 1e-9 * count[h] else count[h] + 1
        c = two.get((h, w), 0)
        return d2[min(c, 6)] * c / total if c else (1 - mass[h] / total) / max(1 - seen[h], unknown) * word(w)

    return one, n, p, count


def trained(key):
    return zlib.crc32(str(key).encode()) % 10 != 0


def train():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0


def test_scores(docs, texts):
    tokens = {k: [*re.findall(brute.WORD, brute.fold(t)), "</s> "] for k, t in texts.items()}
    one, n, p, histories = model(tokens, [k for k in texts if trained(k)])
    got = {r.doc_id: r for r in katz.score(docs, train()).collect()}
    assert set(got) == set(texts)
    for key, words in tokens.items():
        r = got[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(one[w] > 0 for w in words), n)
        assert r.score == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip(["<s> ", *words], words)))
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 0.1) / (n + 0.1 * (len(one) + 1))) for w in words))
    # every history's probabilities sum to 1 over the known words and the unknown one
    for h in list(histories)[:40]:
        assert sum(p(h, w) for w in one) + p(h, "never seen") == pytest.approx(1)


def test_without_training_rows_and_empty(docs, nothing):
    got = katz.score(docs, F.lit(False)).collect()
    assert {r.score for r in got} == {0.0} and {r.n_known for r in got} == {0}
    assert katz.score(nothing, F.lit(True)).count() == 0


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{brute.SF_DIR}/documents.parquet")
    held = katz.score(docs, train()).join(docs.where(~train()).select("doc_id"), "doc_id")
    r = held.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > 0.9 * r.b  # both are negative


def test_the_first_pass_leaves_no_shuffle_files(spark, docs):
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()

    def known():
        return set(re.findall(r"(\d+) ->", shuffles.keySet().mkString("", " -> ", " -> ")))

    before = known()
    found = katz.score(docs, train())  # the counts are kept in files: of the texts' and questions' shuffles nothing is read again
    until = time.time() + 10
    while len(known() - before) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(known() - before) <= 1  # the one of the totals
    assert found.count() == docs.count()
