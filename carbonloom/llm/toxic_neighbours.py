"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Terms are words and, for
inflected and compounded forms, the first ``PREFIXES`` bytes of longer words. The index holds at most
``MAX_EXAMPLES`` labelled texts (distinct ones, in order of a hash of the text) with every term of theirs, which
makes it small enough to broadcast whatever the size of the corpus. Inverse document frequencies count every
row of the scored table. A term weighs more the more surely its presence goes with the label: by ``REST`` plus
chi-square / (chi-square + ``HALF_CHI2``). No term is left out; a term of no example cannot meet any and is not counted.

A text is scored by its ``k`` nearest examples. Examples stand in blocks; a term's greatest weight in each
block bounds every cosine in it, and blocks are evaluated from the greatest bound on until the k-th best
cosine is above all others, so the neighbours are exact. Votes weigh 1 / (distance + 0.1), smoothed by the
base rate; a logistic curve fitted on the examples' leave-one-out votes calibrates them.

Null and empty texts, and texts that share no term with an example, have no neighbours and get the smoothed rate
of examples without a term. Ties in cosine go to the example first in the index. Repeated rows count as rows in the document
frequencies and are scored one by one. Without labelled rows every score is 0. Ids, languages and sources
are never read as inputs of a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carbonloom.llm import hashing as hs

MAX_EXAMPLES = 6_000
HALF_CHI2 = 30.0
PREFIXES = (4, 6)
REST = 0.02
BLOCK = 64
K = 15
#: Texts that are worked on together, and those whose postings are.
BATCH, FEW = 256, 32

_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def terms_of(word: bytes) -> list[bytes]:
    return [word, *(b"^" + word[:n] for n in PREFIXES if len(word) > n)]


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The places begin[0], …, end[0] - 1, begin[1], …"""
    size = end - begin
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


#: Bytes of words.
_INSIDE = np.frombuffer(_TABLE, np.uint8) != 0x20


class Vocabulary:
    """Places of the indexed terms; the texts' words are told apart by 64-bit hashes of their bytes."""

    def __init__(self, terms: pa.Array):
        self.list = terms
        data, offsets = hs.buffers(terms)
        prefix = np.zeros(len(terms), bool)
        some = np.flatnonzero(np.diff(offsets))
        prefix[some] = data[offsets[some]] == ord("^")
        self.hashes = np.zeros(len(terms), np.uint64)
        for a, b in hs.pieces(offsets):
            begin, end = offsets[a:b] + prefix[a:b] - offsets[a], offsets[a + 1 : b + 1] - offsets[a]
            own = hs.Running(data[offsets[a] : offsets[b]]).of(begin, end)
            self.hashes[a:b] = np.where(prefix[a:b], _of_prefix(own), own)

    def __getstate__(self) -> dict:
        """Where texts are read, only hashes are asked."""
        return {"list": None, "hashes": self.hashes}

    def __len__(self) -> int:
        return len(self.hashes)

    @cached_property
    def terms(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(self.list.to_pylist())}

    @cached_property
    def _sorted(self) -> tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]:
        """How far a hash is shifted for its slot, where each slot's hashes begin, all hashes in order, and their places."""
        bits = max(len(self) * 4, 2).bit_length()
        shift, order = np.uint64(64 - bits), np.argsort(self.hashes)
        hashes = self.hashes[order]
        return shift, np.searchsorted(hashes >> shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32), hashes, order

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are of terms, and the terms' places."""
        shift, begin, known, place = self._sorted
        slot = (hashes >> shift).astype(np.int64)
        at, end = begin[slot], begin[slot + 1]
        left, which, found = np.flatnonzero(at < end), [], []
        while len(left):  # few hashes share a slot
            hit = known[at[left]] == hashes[left]
            which.append(left[hit])
            found.append(place[at[left[hit]]])
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        none = [np.zeros(0, np.int64)]
        return np.concatenate(which or none), np.concatenate(found or none)

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the text, place and occurrences of every term of every text, in this order."""
        data, offsets = hs.buffers(texts)
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in hs.pieces(offsets):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            start, end, first = hs.stretches(_INSIDE[part], own)
            text = np.repeat(np.arange(a, b) << 32, np.diff(first))
            running, met = hs.Running(part, fold=True), []
            for n in (None, *PREFIXES):
                some = slice(None) if n is None else np.flatnonzero(end - start > n)
                hashes = running.of(start[some], end[some]) if n is None else _of_prefix(running.of(start[some], start[some] + n))
                which, place = self._find(hashes)
                met.append(text[some][which] | place)
            key, n = np.unique(np.concatenate(met), return_counts=True)
            keys.append(key)
            counts.append(n)
        key = np.concatenate(keys)
        return key >> 32, key & 0xFFFFFFFF, np.concatenate(counts)


def _of_prefix(hashes: np.ndarray) -> np.ndarray:
    """Of a prefix' bytes to the term's: the word of the same bytes has another."""
    return hs.mix(hashes ^ np.uint64(0x707265666978))


def vectors_of(texts: pa.Array, terms: Vocabulary, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of each text and their weights (count times the term's), of length 1; nothing for a text without an indexed term."""
    text, place, n = terms.counts(texts)
    weights = n * weight[place]
    length = np.sqrt(np.bincount(text, weights**2, len(texts)))
    weights = weights / length[text]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(place[a:b], weights[a:b]) for a, b in zip(cuts, cuts[1:])]


class BlockMaxIndex:
    """Postings of each term in order of example, and each term's greatest weight per block.

    The terms of most examples are kept as rows of a matrix, so that a batch of texts meets a block in one product.
    Products are of 32 bits: what comes within ``SLACK`` of the k-th is computed again in 64 bits.
    """

    #: Terms in the matrix at most, and the part of the examples that such a term has at least.
    ROWS, PART = 1_024, 64
    #: More than twice what 1,024 products of 32 bits can be wrong by, for vectors of length 1.
    SLACK = 2e-4

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block, self.n_terms = len(vectors), block, n_terms
        self.blocks = -(-self.n // block)
        self.own_begin = np.concatenate(([0], np.cumsum([len(p) for p, _ in vectors], dtype=np.int64)))
        self.own_term = np.concatenate([p for p, _ in vectors]).astype(np.int32) if vectors else np.zeros(0, np.int32)
        self.own_weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        self.laid_out = False

    def __getstate__(self) -> dict:
        names = ("n", "block", "n_terms", "blocks", "own_begin", "own_term", "own_weight")
        return {x: getattr(self, x) for x in names} | {"laid_out": False}

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.own_begin[i], self.own_begin[i + 1])
        return self.own_term[own], self.own_weight[own]

    def _lay_out(self) -> None:
        """The matrix and the postings, where they are asked; only the examples' vectors are sent there."""
        example = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.own_begin))
        term, weight = self.own_term, self.own_weight
        known = np.bincount(term, minlength=self.n_terms)
        hot = np.argsort(-known, kind="stable")[: self.ROWS]
        hot = hot[known[hot] * self.PART >= max(self.n, 1)]
        self.row = np.full(self.n_terms, -1, np.int32)
        self.row[hot] = np.arange(len(hot))
        row = self.row[term]
        some = row >= 0
        self.hot = np.zeros((len(hot), self.blocks * self.block), np.float32)
        self.hot[row[some], example[some]] = weight[some]
        self.greatest = self.hot.reshape(len(hot), self.blocks, self.block).max(2)
        # the examples' part of the matrix again, in 64 bits
        self.hot_row, self.hot_weight = row[some].astype(np.int16), weight[some]
        self.hot_begin = np.concatenate(([0], np.cumsum(np.bincount(example[some], minlength=self.n))))
        term, example, weight = term[~some], example[~some], weight[~some]
        order = np.argsort(term, kind="stable")
        self.example, self.weight = example[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(self.n_terms + 1))
        self.laid_out = True

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above 0 (``but`` left out), best first, and their cosines."""
        return self.nearest_of([(places, weights)], k, [but])[0]

    def nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each of some vectors, blocks met by all of them together."""
        if not self.n or not texts:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
        if not self.laid_out:
            self._lay_out()
        m, width = len(texts), self.blocks * self.block
        text = np.repeat(np.arange(m), [len(p) for p, _ in texts])
        place = np.concatenate([p for p, _ in texts]).astype(np.int64)
        weight = np.concatenate([w for _, w in texts])
        row = self.row[place]
        some = row >= 0
        exact = np.zeros((m, len(self.hot)))
        exact[text[some], row[some]] = weight[some]
        asked = exact.astype(np.float32)
        # the rarer terms' part of every cosine
        text, place, weight = text[~some], place[~some], weight[~some]
        rare = np.empty((m, width))
        for first in range(0, m, FEW):
            part = slice(*np.searchsorted(text, (first, first + FEW)))
            begin, end = self.begin[place[part]], self.begin[place[part] + 1]
            at, size = _ranges(begin, end), end - begin
            own = rare[first : first + FEW]
            to = np.repeat((text[part] - first) * width, size)
            to += self.example[at]
            value = np.repeat(weight[part], size)
            value *= self.weight[at]
            own[:] = np.bincount(to, value, own.size).reshape(own.shape)
        cosine = rare.astype(np.float32)
        bound = asked @ self.greatest + cosine.reshape(m, self.blocks, self.block).max(2)
        done = np.zeros((m, self.blocks), bool)
        left_out = [(i, x) for i, x in enumerate(but or []) if 0 <= x < self.n]

        def meet(chosen: np.ndarray) -> np.ndarray:
            """Cosines with the examples of the blocks met so far, and 0 for others."""
            for b in np.flatnonzero(chosen.any(0)):
                rows = np.flatnonzero(chosen[:, b])
                own = slice(b * self.block, (b + 1) * self.block)
                cosine[rows, own] += (asked if len(rows) == m else asked[rows]) @ self.hot[:, own]
            done[chosen] = True
            found = np.where(np.repeat(done, self.block, 1), cosine, np.float32(0))
            for i, x in left_out:
                found[i, x] = 0
            return found

        def kth(found: np.ndarray) -> np.ndarray:
            return np.partition(found, width - k, 1)[:, width - k] if width > k else np.zeros(m, np.float32)

        first = np.zeros((m, self.blocks), bool)
        some = min(2, self.blocks)
        np.put_along_axis(first, np.argpartition(-bound, some - 1, 1)[:, :some], True, 1)
        found = meet(first & (bound > 0))
        found = meet(~done & (bound > 0) & (bound >= kth(found)[:, None] - self.SLACK))
        near = (found > 0) & (found >= kth(found)[:, None] - self.SLACK)
        out = []
        for i in range(m):
            best = np.flatnonzero(near[i])
            begin, size = self.hot_begin[best], self.hot_begin[best + 1] - self.hot_begin[best]
            at = _ranges(begin, begin + size)
            value = exact[i].take(self.hot_row[at])
            value *= self.hot_weight[at]
            cosines = rare[i, best] + np.bincount(np.repeat(np.arange(len(best)), size), value, len(best))
            order = np.lexsort((best, -cosines))[:k]
            out.append((best[order], cosines[order]))
        return out


@dataclass
class Model:
    terms: Vocabulary
    weight: np.ndarray
    index: BlockMaxIndex
    labels: np.ndarray
    example_ids: list
    rate: float
    none_rate: float
    slope: float
    shift: float
    k: int

    def votes(self, near: np.ndarray, cosines: np.ndarray) -> float:
        """Distance-weighted share of label 1, smoothed by one vote of the base rate."""
        weights = 1 / (np.maximum(1 - cosines, 0) + 0.1)
        return float((weights @ self.labels[near] + self.rate) / (weights.sum() + 1))

    def scores(self, texts: pa.Array) -> list[tuple[float, np.ndarray, np.ndarray]]:
        out = []
        for a in range(0, len(texts), BATCH):
            for near, cosines in self.index.nearest_of(vectors_of(texts.slice(a, BATCH), self.terms, self.weight), self.k):
                p = _logistic(self.slope * _logit(self.votes(near, cosines)) + self.shift) if len(near) else self.none_rate
                out.append((p, near, cosines))
        return out


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -500.0), 500.0)))


def _calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (0.1 to 10) and shift of a logistic curve over the votes' logits, by Newton's method with a small penalty."""
    if len(votes) < 2 or labels.min() == labels.max():
        return 1.0, 0.0
    x = np.log(votes / (1 - votes))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - labels) * x).sum() + (a - 1), (p - labels).sum() + b])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        move = np.linalg.solve(h, g)
        a, b = float(np.clip(a - move[0], 0.1, 10)), float(np.clip(b - move[1], -20, 20))
        if abs(move).max() < 1e-9:
            break
    return a, b


def _examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` distinct labelled texts (place, id, text, label), in order of a hash of the text.

    Equal texts are one example of their mean label, rounded. The order needs only ids and hashes.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")).where("_y IS NOT NULL")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text IS NOT NULL")
    hashed = texts.select("_id", F.xxhash64("_text").alias("_h"), F.octet_length("_text").alias("_n"))
    first = (
        known.join(hashed, "_id")
        .groupBy("_h", "_n")
        .agg(F.min("_id").alias("_id"), F.round(F.avg("_y")).cast("int").alias("label"))
        .orderBy("_h", "_n")
        .limit(rows)
    )
    # a row stored several times, or several texts of one id: one example per text all the same
    chosen = first.join(texts, "_id").where((F.xxhash64("_text") == F.col("_h")) & (F.octet_length("_text") == F.col("_n")))
    chosen = chosen.dropDuplicates(["_h", "_n"])
    return chosen.select("_h", "_n", F.col("_id").alias("id"), F.col("_text").alias("text"), "label")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_examples: int = MAX_EXAMPLES,
    k: int = K,
    corpus: DataFrame | None = None,
) -> Model:
    """Learns from ``labels`` (give only rows that may be learnt from); document frequencies from ``corpus`` or ``docs``.

    The driver gets the examples' terms and their counts.
    """
    corpus = docs if corpus is None else corpus
    examples = _examples(docs, labels, id_col, text_col, label_col, max_examples).persist()
    try:
        totals = examples.agg(F.count("*").alias("n"), F.sum("label").alias("p")).first()
        n, positive = totals.n, totals.p or 0

        def distinct_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                counts: dict[bytes, list[int]] = {}
                for text, label in zip(frame["text"], frame["label"]):
                    for word in {t for w in set(tokens(text)) for t in terms_of(w)}:
                        counts.setdefault(word, [0, 0])[int(label)] += 1
                yield pd.DataFrame({"word": list(counts), "n0": [c[0] for c in counts.values()], "n1": [c[1] for c in counts.values()]})

        words = examples.select("text", "label").mapInPandas(distinct_words, "word binary, n0 long, n1 long")
        words = words.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        found = words.toArrow()
        a, b = (found[x].to_numpy().astype(float) for x in ("n1", "n0"))
        c, d = positive - a, n - positive - b
        # 2 x 2 chi-square of a word's presence and the label; a word of every example tells nothing
        below = (a + b) * (c + d) * (a + c) * (b + d)
        chi2 = n * (a * d - b * c) ** 2 / np.where(below > 0, below, np.inf)
        order = pc.sort_indices(found.append_column("chi2", pa.array(chi2)), sort_keys=[("chi2", "descending"), ("word", "ascending")])
        terms, chi2 = Vocabulary(found["word"].take(order).combine_chunks()), chi2[order.to_numpy()]
        del found, a, b, c, d, below, order

        def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(len(terms) + 1, np.int64)
            for batch in batches:
                for at in range(0, len(batch), BATCH):
                    counts[:-1] += np.bincount(terms.counts(batch.column(0).slice(at, BATCH))[1], minlength=len(terms))
                counts[-1] += len(batch)
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "n"])

        known = np.zeros(len(terms) + 1, np.int64)
        if len(terms):
            total = corpus.select(F.col(text_col).alias("text")).mapInArrow(frequencies, "term long, n long")
            total = total.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
            known[total["term"].to_numpy()] = total["n"].to_numpy()
        idf = np.log((1 + known[-1]) / (1 + known[:-1])) + 1
        weight = idf * (REST + chi2 / (chi2 + HALF_CHI2))

        def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                found = vectors_of(pa.array(frame["text"], pa.string()), terms, weight)
                yield pd.DataFrame(
                    {"h": frame["_h"], "n": frame["_n"], "id": frame["id"], "label": frame["label"], "places": [p.astype(np.int32).tobytes() for p, _ in found], "weights": [w.tobytes() for _, w in found]}
                )

        ids = examples.schema["id"].dataType.simpleString()
        known = examples.mapInPandas(counted, f"h long, n int, id {ids}, label int, places binary, weights binary")
        known = known.toArrow().sort_by([("h", "ascending"), ("n", "ascending")])
    finally:
        examples.unpersist()
    label, name = known["label"].to_numpy(), known["id"].to_pylist()
    vectors = [(np.frombuffer(p.as_buffer(), np.int32), np.frombuffer(w.as_buffer())) for p, w in zip(known["places"], known["weights"])]
    none = [label[i] for i, (p, _) in enumerate(vectors) if not len(p)]
    # examples that share their heaviest term stand together, so that block bounds are tight
    some = [(p[int(np.argmax(w))], -w.max(), i) for i, (p, w) in enumerate(vectors) if len(p)]
    some = [i for _, _, i in sorted(some)]
    index = BlockMaxIndex([vectors[i] for i in some], len(terms))
    del known, vectors
    rate = min(max(positive / n, 1e-3), 1 - 1e-3) if n else 0.0
    model = Model(
        terms, weight, index, label[some].astype(float), [name[i] for i in some], rate,
        (sum(none) + rate) / (len(none) + 1) if n else 0.0, 1.0, 0.0, k,
    )
    if index.n:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in batches:
                every = batch.column(0).to_pylist()
                for a in range(0, len(every), BATCH):
                    some = every[a : a + BATCH]
                    near = m.index.nearest_of([m.index.vector(i) for i in some], m.k, some)
                    votes = [m.votes(*x) if len(x[0]) else None for x in near]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(votes, pa.float64())], names=["id", "vote"])

        parts = -(-index.n // (4 * BATCH))
        votes = docs.sparkSession.range(0, index.n, 1, parts).mapInArrow(left_out, "id long, vote double").where("vote IS NOT NULL").toArrow().sort_by("id")
        shared.unpersist()
        model.slope, model.shift = _calibrate(votes["vote"].to_numpy(), model.labels[votes["id"].to_numpy()])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", evidence: int = 3) -> DataFrame:
    """id, score, predicted and the nearest ``evidence`` examples (id, cosine, label) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ids = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = m.scores(batch.column(1))
            near = [
                [{"example": str(m.example_ids[i]), "cosine": float(c), "label": int(m.labels[i])} for i, c in zip(a[:evidence], b[:evidence])]
                for _, a, b in found
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _, _ in found], pa.float64()), pa.array(near, kind)], names=["id", "score", "evidence"]
            )

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {ids}, score double, evidence array<struct<example:string,cosine:double,label:int>>"
    )
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
