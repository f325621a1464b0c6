"""The best documents for each item, from frequency trees of the documents' restricted term vectors.

A document is restricted to the terms that occur in any item: that vector (term, tf) and the document's length is all that is
kept of its text. In a task, the vectors of some thousands of documents are sorted by their terms, the most frequent term
first, so that documents that begin alike share a path of a prefix tree (an FP-tree). Paths without a branch are one
node, and small neighbours under one parent share a leaf. Every node knows, over all documents below it, the largest tf of
each term and the smallest m; a term's part of the score grows with tf and falls with m, so the two bound every score
below. Each item walks the tree depth first, the child with the highest bound first, and leaves out every
subtree whose bound is under its present last rank; the documents of the leaves it reaches are scored exactly. The ranks
reached go on from tree to tree of a task; a window over the tasks' rows gives the final ranks.

Scores are 64-bit integers throughout, so the bounds are exact and nothing is lost by rounding.

Items are taken in groups of at most ``ITEM_BYTES`` of text, so what a task gets sent is bounded whatever the benchmark's size;
the documents' texts are read once per group. An item is a distinct pair of id and text; items without terms have no rows.
Null and empty texts have no terms, are not counted and never ranked; repeated rows are documents of their own (equal ids
rank in any order among themselves); a null id comes last among equal scores. No items or no documents: no rows. Only the id
and text columns are read, whatever the others are called.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from carbonloom.llm.shared import stored

#: Text of the items that are searched for together, at most (one longer item is a group of its own).
ITEM_BYTES = 128 << 10
#: Documents and vector entries of one tree, and documents of one leaf, at most (but for one long vector).
TREE_DOCS, TREE_ENTRIES, LEAF = 16_384, 2_000_000, 64

_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Runs of 0-9, A-Z, a-z and bytes beyond ASCII; A-Z lower-cased."""
    return (text or b"").translate(_TABLE).split()


def restricted(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs): each text's number of terms, and its terms of ``vocabulary`` (a broadcast dict to numbers)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.get
        for batch in batches:
            sizes, found, tfs = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = terms(text.as_py())
                counts = Counter(map(known, words))
                counts.pop(None, None)
                sizes.append(len(words))
                found.append(list(counts))
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip((sizes, found, tfs), list(schema)[1:]))], schema=schema)

    df = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return df.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


class Tree:
    """The prefix tree of some documents. ``ranks``: of each document's terms, the most frequent term is 0."""

    def __init__(self, ids: pa.Array, m: np.ndarray, offsets: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, n_terms: int):
        owner = np.repeat(np.arange(len(m)), np.diff(offsets))
        inner = np.lexsort((ranks, owner))
        ranks, tfs = ranks[inner], tfs[inner]
        raw = ranks.astype(">u4").tobytes()
        keys = [raw[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        sizes = np.diff(offsets)[order]
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        take = np.repeat(offsets[:-1][order] - self.offsets[:-1], sizes) + np.arange(self.offsets[-1])
        self.ranks, tfs, m = ranks[take], tfs[take].astype(np.int64), m[order]
        self.ids = ids.take(pa.array(order))
        #: Each entry's part of a score, but for the term's weight.
        self.parts = _part(tfs, np.repeat(m, sizes))
        self._grow(n_terms)
        # leaves first, then each parent from its children, which all have higher numbers
        tf_max = np.zeros((len(self.first), n_terms), np.int64)
        m_min = np.full(len(self.first), np.iinfo(np.int64).max)
        leaf = np.flatnonzero(self.leaf)
        leaf = leaf[np.argsort(self.first[leaf])]  # leaves part the documents among them
        np.minimum.at(m_min, np.repeat(leaf, self.last[leaf] - self.first[leaf]), m)
        of_entry = np.repeat(leaf, self.offsets[self.last[leaf]] - self.offsets[self.first[leaf]])
        np.maximum.at(tf_max, (of_entry, self.ranks), tfs)
        for node in range(len(self.first) - 1, -1, -1):
            if not self.leaf[node]:
                kids = self.children[node]
                tf_max[node] = tf_max[kids].max(0)
                m_min[node] = m_min[kids].min()
        #: The most that each term can add below each node, but for its weight.
        self.most = _part(tf_max, m_min[:, None])

    def _grow(self, n_terms: int) -> None:
        """Nodes as runs of the sorted documents; a node's children follow it, in order."""
        first, last, depth, self.children = [0], [len(self.ids)], [0], []
        at = 0
        while at < len(first):
            a, b, d = first[at], last[at], depth[at]
            kids: list[int] = []
            if b - a > LEAF:
                low, size = self.offsets[a:b], np.diff(self.offsets[a : b + 1])
                while True:  # as far as all documents go on with the same term
                    term = np.full(b - a, -1)
                    has = size > d
                    term[has] = self.ranks[low[has] + d]
                    if not has.any() or term[0] != term[-1]:
                        break
                    d += 1
                cuts = [a, *(a + 1 + np.flatnonzero(np.diff(term))).tolist(), b]
                if len(cuts) == 2:  # equal vectors: cut by number
                    cuts = [*range(a, b, LEAF), b]
                begin = a
                for left, right, after in zip(cuts, cuts[1:], [*cuts[2:], None]):
                    if after is None or after - begin > LEAF:
                        kids.append(len(first))
                        first.append(begin)
                        last.append(right)
                        depth.append(d + 1 if begin == left else d)
                        begin = right
            self.children.append(np.array(kids, np.int64))
            at += 1
        self.first, self.last = np.array(first), np.array(last)
        self.leaf = np.array([not len(k) for k in self.children])

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: Best, dense: np.ndarray) -> int:
        """Gives ``best`` all documents that can still rank; the number of leaves that were read. ``dense`` is zeros, one per term."""
        dense[ranks] = weights
        stack = [(0, int(self.most[0, ranks] @ weights))]
        read = 0
        while stack:
            node, bound = stack.pop()
            if bound < best.floor:
                continue
            if self.leaf[node]:
                read += 1
                a, b = self.first[node], self.last[node]
                low, high = self.offsets[a], self.offsets[b]
                sums = np.concatenate(([0], np.cumsum(dense[self.ranks[low:high]] * self.parts[low:high])))
                ends = self.offsets[a : b + 1] - low
                scores = sums[ends[1:]] - sums[ends[:-1]]
                good = np.flatnonzero(scores >= best.floor)
                if len(good):
                    best.add(scores[good], self.ids.take(pa.array(good + a)))
                continue
            kids = self.children[node]
            bounds = self.most[np.ix_(kids, ranks)] @ weights
            order = np.argsort(bounds, kind="stable")  # the highest last: it is taken first
            stack.extend((int(kids[i]), int(bounds[i])) for i in order if bounds[i] >= best.floor)
        dense[ranks] = 0
        return read


def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(1000000000*tf) div (1000*tf + 20*m); nothing for tf 0."""
    return np.where(tf > 0, 1_000_000_000 * tf // np.maximum(1000 * tf + 20 * np.minimum(m, 1 << 58), 1), 0)


class Best:
    """The best ``k`` documents so far; ``floor`` is the least score that can still rank, 1 at least."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.scores, self.ids = np.zeros(0, np.int64), pa.array([], pa.int64())

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        scores, ids = np.concatenate((self.scores, scores)), pa.concat_arrays([self.ids, ids])
        none = np.asarray(ids.is_null())
        order = np.lexsort((np.asarray(ids.fill_null(0)), none, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids.take(pa.array(order))
        if len(order) == self.k:
            self.floor = max(1, int(self.scores[-1]))


def _trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray, n_docs: int, length: int) -> Iterator[Tree]:
    """A tree for every run of documents within the limits; frees it before the next is made."""
    held: list[pa.RecordBatch] = []

    def tree() -> Tree:
        rows = pa.Table.from_batches(held).combine_chunks()
        lists, tfs = (pa.concat_arrays(rows[c].chunks) for c in ("terms", "tfs"))
        offsets = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
        # Python's integers where the product could pass 64 bits
        n = np.asarray(rows["n"])
        big = 50 * int(n.max()) * n_docs >= 1 << 63
        m = np.array([50 + 50 * int(x) * n_docs // length for x in n]) if big else 50 + 50 * n * n_docs // length
        return Tree(pa.concat_arrays(rows["id"].chunks), m, offsets, rank[np.asarray(lists.flatten())], np.asarray(tfs.flatten()), len(rank))

    docs = entries = 0
    for batch in batches:
        at = 0
        lists = batch.column("terms")
        ends = np.asarray(lists.offsets).astype(np.int64)[1:] - lists.offsets[0].as_py()
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            more = int(np.searchsorted(ends, before + TREE_ENTRIES - entries, side="right")) - at
            more = min(max(more, 0 if held else 1), TREE_DOCS - docs, batch.num_rows - at)
            if more:
                held.append(batch.slice(at, more))
                at, docs, entries = at + more, docs + more, entries + int(ends[at + more - 1] - before)
            if at < batch.num_rows or docs >= TREE_DOCS:
                yield tree()
                held.clear()
                docs = entries = 0
    if held:
        yield tree()


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).distinct()
    wanted = wanted.where(F.col("text").isNotNull())
    total = wanted.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    groups = -(-total * 2 // ITEM_BYTES) if total > ITEM_BYTES // 2 else 1
    out = None
    for group in range(groups):
        part = wanted if groups == 1 else wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group)
        found = _search_group(spark, docs, part, k, id_col, text_col)
        out = found if out is None else out.union(found)
    return out.withColumnsRenamed({"item": item_col, "id": id_col})


def _search_group(spark, docs: DataFrame, items: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    rows = [(r.item, sorted(set(terms(r.text.encode())))) for r in items.collect()]
    rows = [(item, words) for item, words in rows if words]
    vocabulary = {word: i for i, word in enumerate(sorted({w for _, words in rows for w in words}))}
    vectors = stored(restricted(docs, spark.sparkContext.broadcast(vocabulary), id_col, text_col), "vectors")
    whole = vectors.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r.term] = r["count"]
    n_docs, length = whole.n or 0, whole.l or 0
    by_rank = np.argsort(-df, kind="stable")
    rank = np.empty(len(df), np.int64)
    rank[by_rank] = np.arange(len(df))
    # floor(1000*ln((2*N+2)/(2*df+1))), one double at a time as SQL does
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df[by_rank]], np.int64)
    queries = [(item, np.sort(rank[[vocabulary[w] for w in words]])) for item, words in rows]
    sent = spark.sparkContext.broadcast((rank, weight, queries, n_docs, length))
    kind = items.schema["item"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, weight, queries, n_docs, length = sent.value
        best = [Best(k) for _ in queries]
        dense = np.zeros(len(weight), np.int64)
        for tree in _trees(batches, rank, n_docs, length):
            for (_, ranks), b in zip(queries, best):
                tree.search(ranks, weight[ranks], b, dense)
        for i, ((item, _), b) in enumerate(zip(queries, best)):
            if len(b.ids):
                columns = [pa.array([i] * len(b.ids), pa.int32()), pa.array([item] * len(b.ids), arrow_kind), b.ids, pa.array(b.scores, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["number", "item", "id", "score"])

    schema = StructType([*StructType.fromDDL("number int").fields, StructField("item", kind), *StructType.fromDDL("id long, score long").fields])
    found = vectors.where(F.size("terms") > 0).mapInArrow(run, schema)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item", "rank", "id", "score")
