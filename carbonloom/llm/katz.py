"""A Katz backoff model of word pairs: Good-Turing discounted counts and exactly normalised backoff weights.

Tokens are words (A-Z lower-cased) and one end per text; the first token's history is a start mark. With
c the training count of a pair (h, w) and d the Good-Turing discount of its order,

    P(w | h) = d(c) * c / c(h)          if the pair was seen,
    P(w | h) = alpha(h) * P(w)          else; alpha(h) makes the sum over all words 1,
    P(w)     = d(c) * c / N             for known words; what is left is the one unknown word's.

Counts up to ``CUTOFF`` are discounted (Katz' form, where it gives a value between 0 and 1; else not at
all). A history whose seen words would leave no mass counts once more. A history without training counts
has P(w | h) = P(w).

Counting and scoring go through ``chunks``: every chunk of texts asks for the counts of its distinct words and
pairs; the answers are the count tables, kept in ranges of the key space. For the weights, each pair is summed up
under its history by the one chunk that owns it. Nothing but counts of counts reaches the driver.

A null or empty text is its end token alone. Without training texts every word is unknown, of probability 1.
Rows are scored one by one; equal rows all count. Columns beside id and text are read by ``train`` only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carbonloom.llm import chunks as ch
from carbonloom.llm import hashing as hs
from carbonloom.llm.shared import let_go, stored

CUTOFF = 5
START, END = (hs.mix(np.array([x], np.uint64))[0] for x in (0x53544152, 0x454E44))
WORDS, PAIRS, WEIGHTS = 0, 1, 2


class Tokens:
    """The tokens of a chunk: distinct words and pairs, and for every token the places of its word, pair and history."""

    def __init__(self, texts: pa.Table):
        hashes, firsts = hs.words(texts["text"])
        counts = np.diff(firsts)
        self.ends = np.cumsum(counts + 1)
        self.begins = self.ends - counts - 1
        token = np.empty(len(hashes) + len(counts), np.uint64)
        last = np.zeros(len(token), bool)
        last[self.ends - 1] = True
        token[last], token[~last] = END, hashes
        train = np.repeat(texts["flag"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool), counts + 1)
        self.words, self.word = np.unique(token, return_inverse=True)
        # the history's place; START stands after all words
        self.history = np.empty(len(token), np.int64)
        self.history[1:] = self.word[:-1]
        self.history[self.begins] = len(self.words)
        before = np.append(self.words, START)[self.history]
        self.pairs, first, self.pair = np.unique(
            hs.mix(before * np.uint64(0x9FB21C651E98DF25) + token), return_index=True, return_inverse=True
        )
        self.pair_word, self.pair_history = self.word[first], self.history[first]
        self.word_counts = np.bincount(self.word, weights=train, minlength=len(self.words)).astype(np.int64)
        self.pair_counts = np.bincount(self.pair, weights=train, minlength=len(self.pairs)).astype(np.int64)


def _asked(kind: int, buckets: int, keys: np.ndarray, *values: np.ndarray) -> list[tuple]:
    cuts = ch.bucket_cuts(keys, buckets)
    return [
        (kind * buckets + i, ch.put_keys(keys[a:b]), [ch.put(v[a:b]) for v in values])
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if b > a
    ]


def _sums(blocks: list[dict], column: int, kind) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Keys by block, the order that sorts them all, where each key begins in it, and each key's total."""
    keys = [ch.get_keys(b["keys"]) for b in blocks]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    begin = ch.runs(every[order])
    values = np.concatenate([ch.get(b["values"][column], kind) for b in blocks])[order]
    return keys, order, begin, np.add.reduceat(values, begin)


def _spread(order: np.ndarray, begin: np.ndarray, totals: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), totals.dtype)
    out[order] = np.repeat(totals, np.diff(np.append(begin, len(order))))
    return out


def _count(blocks: list[dict]) -> list[tuple]:
    """Corpus counts in the order of each block, which of its keys a block owns, and the bucket's counts of counts."""
    keys, order, begin, totals = _sums(blocks, 0, np.int64)
    counts = _spread(order, begin, totals)
    owned = np.zeros(len(order), bool)
    owned[order[begin]] = True  # the sort is stable: the first block that has the key
    stats = [int(totals.sum()), int((totals > 0).sum()), *(int((totals == r).sum()) for r in range(1, CUTOFF + 2))]
    out, at = [], 0
    for i, (block, own) in enumerate(zip(blocks, keys)):
        part = slice(at, at + len(own))
        out.append((block["chunk"], [ch.put(counts[part]), ch.put(owned[part])], stats if i == 0 else None))
        at += len(own)
    return out


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d(0) to d(CUTOFF), then 1 for all larger counts; ``counts_of_counts`` has n(1) to n(CUTOFF + 1)."""
    out = np.ones(CUTOFF + 2)
    n = [0, *counts_of_counts]
    if n[1]:
        common = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
        for r in range(1, CUTOFF + 1):
            if n[r] and common < 1:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                out[r] = d if 0 < d < 1 else 1.0
    return out


class Model:
    """What all chunks share: totals, vocabulary size and discounts."""

    def __init__(self, words: list[int], pairs: list[int]):
        self.total, self.vocabulary = words[0], words[1]
        self.word_discounts, self.pair_discounts = discounts(words[2:]), discounts(pairs[2:])
        held = sum((1 - self.word_discounts[r]) * r * words[1 + r] for r in range(1, CUTOFF + 1))
        # without discounts the unknown word counts once
        self.size = float(self.total) if held > 0 else self.total + 1.0
        self.unknown = held / self.size if held > 0 else 1 / self.size

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        known = self.word_discounts[np.minimum(counts, CUTOFF + 1)] * counts / self.size
        return np.where(counts > 0, known, self.unknown)

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return self.pair_discounts[np.minimum(counts, CUTOFF + 1)] * counts


def _weigh(model: Model):
    def reply(blocks: list[dict]) -> list[tuple]:
        """log10 of alpha and of the denominator for every history, in the order of its block."""
        keys, order, begin, count = _sums(blocks, 0, np.float64)
        _, _, _, mass = _sums(blocks, 1, np.float64)
        _, _, _, seen = _sums(blocks, 2, np.float64)
        size = np.where(count - mass > 1e-9 * count, count, count + 1)
        alpha = (1 - mass / size) / np.maximum(1 - seen, model.unknown)
        logs = [_spread(order, begin, np.log10(x)) for x in (alpha, size)]
        out, at = [], 0
        for block, own in zip(blocks, keys):
            out.append((block["chunk"], [ch.put(x[at : at + len(own)]) for x in logs], None))
            at += len(own)
        return out

    return reply


_REPLY = "values array<binary>, stats array<long>"
_ASK = "bucket int, keys binary, values array<binary>"


def _replies(table: pa.Table, kind: int, buckets: int, types: tuple) -> list[np.ndarray]:
    rows = sorted((r for r in table.select(["bucket", "values"]).to_pylist() if r["bucket"] // buckets == kind), key=lambda r: r["bucket"])
    return [np.concatenate([ch.get(r["values"][i], t) for r in rows]) if rows else np.zeros(0, t) for i, t in enumerate(types)]


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score (add-0.1 unigram) and score, log10 of the text's probability.

    ``train`` says which rows the model learns from.
    """
    buckets = ch.chunk_count(docs)
    packed = ch.pack(docs, id_col, text_col, buckets, train)

    def count_question(texts: pa.Table) -> list[tuple]:
        t = Tokens(texts)
        return _asked(WORDS, buckets, t.words, t.word_counts) + _asked(PAIRS, buckets, t.pairs, t.pair_counts)

    counts = stored(ch.answer(ch.ask(packed, count_question, _ASK), _count, _REPLY), "counts")
    totals = {
        r.kind: [r[f"s{i}"] for i in range(CUTOFF + 3)]
        for r in counts.where("stats IS NOT NULL")
        .groupBy(F.floor(F.col("bucket") / buckets).alias("kind"))
        .agg(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(CUTOFF + 3)))
        .collect()
    }
    # the plan that wrote the counts is gone by now; one of ``checkpoint`` would live on with its table
    let_go(docs.sparkSession)
    none = [0] * (CUTOFF + 3)
    model = Model(totals.get(WORDS, none), totals.get(PAIRS, none))

    def histories(t: Tokens, word_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the chunk's histories that may have training counts, and their places in ``Tokens``."""
        places = np.append(np.flatnonzero((word_counts > 0) & (t.words != END)), len(t.words))
        keys = np.append(t.words, START)[places]
        order = np.argsort(keys)
        return keys[order], places[order]

    form = ch.kinds(f"chunk int, {_ASK}")

    def weight_question(texts: pa.Table, replies: pa.Table) -> pa.Table:
        t = Tokens(texts)
        (words,) = _replies(replies, WORDS, buckets, (np.int64,))
        pairs, owned = _replies(replies, PAIRS, buckets, (np.int64, np.bool_))
        own = np.flatnonzero(owned & (pairs > 0))
        history, n = t.pair_history[own], len(t.words) + 1
        sums = [
            np.bincount(history, weights=w, minlength=n)
            for w in (pairs[own].astype(float), model.discounted(pairs[own]), model.word_probability(words[t.pair_word[own]]))
        ]
        keys, places = histories(t, words)
        rows = _asked(WEIGHTS, buckets, keys, *(s[places] for s in sums))
        chunk = ch.chunk_of(texts)
        return ch.table([(chunk, *r) for r in rows], form)

    def evaluate(texts: pa.Table, replies: pa.Table) -> pa.Table:
        t = Tokens(texts)
        (words,) = _replies(replies, WORDS, buckets, (np.int64,))
        pairs, _ = _replies(replies, PAIRS, buckets, (np.int64, np.bool_))
        alpha, size = _replies(replies, WEIGHTS, buckets, (np.float64, np.float64))
        _, places = histories(t, words)
        log_alpha, log_size = np.zeros(len(t.words) + 1), np.zeros(len(t.words) + 1)
        # a start without training texts has weights of no meaning
        valid = np.isfinite(alpha) & np.isfinite(size)
        log_alpha[places], log_size[places] = np.where(valid, alpha, 0), np.where(valid, size, 0)
        with np.errstate(divide="ignore"):
            log_word = np.log10(model.word_probability(words))
            log_pair = np.log10(model.discounted(pairs)) - log_size[t.pair_history]
        log_pair = np.where(pairs > 0, log_pair, log_alpha[t.pair_history] + log_word[t.pair_word])
        base = np.log10((words + 0.1) / (model.total + 0.1 * (model.vocabulary + 1)))
        per_text = lambda x: np.add.reduceat(x, t.begins) if len(t.begins) else x  # noqa: E731  a text has a token at least
        return pa.table(
            {
                "doc_id": texts["id"],
                "n_tokens": pa.array(t.ends - t.begins),
                "n_known": pa.array(per_text((words > 0)[t.word].astype(np.int64))),
                "train_tokens": pa.array(np.full(len(t.begins), model.total)),
                "base_score": pa.array(per_text(base[t.word])),
                "score": pa.array(per_text(log_pair[t.pair])),
            }
        )

    weights = ch.answer(ch.meet(packed, counts, weight_question, f"chunk int, {_ASK}"), _weigh(model), _REPLY)
    return ch.meet(
        packed,
        counts.union(weights),
        evaluate,
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
