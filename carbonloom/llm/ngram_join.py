"""Near copies by the Jaccard similarity of word n-grams: prefix filters under several global orders.

A document's set holds its distinct 5-word shingles (words A-Z lower-cased); with fewer words, the whole
sequence is one. Two sets of similarity t or more share a token among the first n - ceil(t * n) + 1 tokens
of each, in any order that is the same for all sets. Candidates must share a prefix token under every one of
three orders: rarest first by document frequency, rarest first with other ties, and by hash alone. Tokens of
frequency 1 cannot be shared, so most documents have no prefix left under the first order and cost no more.
Under the first order, what two sets can still share after a common token must be enough, too. What passes
all filters is verified on the sets.

Equal sets are one class and go through the join once. A group of near copies is linked through hubs, never
pair by pair (``components.linked_groups``).

Null and empty texts, and texts without words, have an empty set, link with nothing and are their own
component. Rows are judged one by one, also rows of one id with different texts; a null id is never a component's name unless
all its ids are null. Columns beside id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carbonloom.llm import chunks as ch
from carbonloom.llm import hashing as hs
from carbonloom.llm.components import WORDS, bitmaps, linked_groups, saved, sketch

SHINGLE = 5
PERCENT = 75
#: Tokens of whole sets that are ordered together, so that the arrays of a step stay small.
_TOKENS = 128 << 10


def _sets(texts: pa.ChunkedArray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles by text: hashes in order of text and hash, and the sets' sizes. A piece of the texts at a
    time, so that words and repeated shingles of few texts are in memory."""
    found, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in hs.pieces(hs.buffers(texts)[1]):
        hashes, of = hs.grams(*hs.words(texts.slice(a, b - a)), n)
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        if len(of):
            first = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])))
            hashes, of = hashes[first], of[first]
        found.append(hashes)
        sizes.append(np.bincount(of, minlength=b - a).astype(np.int64))
    return np.concatenate(found), np.concatenate(sizes)


def _frequencies(blocks: list[dict]) -> list[tuple]:
    """For the blocks of a bucket: the corpus frequency of every key, 255 at most, in the order of its block."""
    keys = [ch.get_keys(b["keys"]) for b in blocks]
    counts = [ch.get(b["counts"], np.uint32) for b in blocks]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    begin = ch.runs(every[order])
    total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    of = np.empty(len(every), np.int64)
    of[order] = np.repeat(np.minimum(total, 255), np.diff(np.append(begin, len(every))))
    out, at = [], 0
    for block, own in zip(blocks, keys):
        out.append((block["chunk"], ch.put(of[at : at + len(own)].astype(np.uint8))))
        at += len(own)
    return out


_SCHEMA = (
    "doc_id long, text_key long, n_shingles long, s1 long, s2 long, shared array<long>, p1 array<long>, at1 array<int>, "
    "p2 array<long>, p3 array<long>, words array<long>, spare long"
)


def _text_key(text_col: str):
    """Tells the texts of one id apart."""
    return F.xxhash64(F.col(text_col))


def signatures(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, set size, two sums that identify the set, and for one row of each class and chunk whose prefix
    under the first order holds a shared token: the shared tokens and the shared tokens of the three prefixes."""
    buckets = ch.chunk_count(docs)
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _text_key(text_col).alias("text_key"))
    packed = ch.pack(named, "id", "text", buckets, extra=("text_key",))

    # frequencies are asked for by the first bits of a hash, 12 more than would number all tokens: an order needs no more
    cut = np.uint64(max(0, 64 - 12 - (buckets << 22).bit_length()))

    def question(texts: pa.Table) -> list[tuple]:
        keys, _ = _sets(texts["text"], n)
        keys >>= cut
        keys.sort()
        begin = ch.runs(keys)
        keys, counts = keys[begin], np.diff(np.append(begin, len(keys)))
        cuts = ch.bucket_cuts(keys << cut, buckets)
        return [
            (i, ch.put_keys(keys[a:b]), ch.put(counts[a:b].astype(np.uint32)))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if b > a
        ]

    def use(texts: pa.Table, replies: pa.Table) -> pa.Table:
        hashes, sizes = _sets(texts["text"], n)
        rows = sorted(replies.to_pylist(), key=lambda r: r["bucket"])
        df = frequency_of(hashes >> cut, np.concatenate([np.zeros(0, np.uint8), *(ch.get(r["df"], np.uint8) for r in rows)]))
        begin = np.concatenate(([0], np.cumsum(sizes)))
        runs = hs.pieces(begin, _TOKENS)
        sums = np.zeros((2, len(sizes)), np.uint64)
        for a, b in runs:
            own, at = hashes[begin[a] : begin[b]], begin[a : b + 1] - begin[a]
            for k in range(len(sums)):
                running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hs.mix(own + np.uint64(k + 1)), dtype=np.uint64)))
                sums[k, a:b] = running[at[1:]] - running[at[:-1]]
        # one row of each class is enough: the one of smallest id, as the table is in order of id behind null ids
        by_id = np.roll(np.arange(len(sizes)), -texts["id"].null_count)
        _, first = np.unique(np.stack([sizes.astype(np.uint64), *sums], 1)[by_id], axis=0, return_index=True)
        once = np.zeros(len(sizes), bool)
        once[by_id[first]] = True
        batches = []
        for a, b in runs:
            own = slice(begin[a], begin[b])
            head = [texts[c].slice(a, b - a).combine_chunks() for c in ("id", "e0")]
            head += [pa.array(sizes[a:b]), *(pa.array(x[a:b].view(np.int64)) for x in sums)]
            batches.append(pa.RecordBatch.from_arrays(head + ordered(hashes[own], df[own].astype(np.int64), sizes[a:b], once[a:b]), names=form.names))
        return pa.Table.from_batches(batches)

    def frequency_of(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The frequency of every key; ``known`` has them in order of the distinct keys."""
        order = np.argsort(keys)
        new = np.zeros(len(keys), bool)
        new[ch.runs(keys[order])] = True
        df = np.empty(len(keys), np.uint8)
        df[order] = known[np.cumsum(new) - 1]
        return df

    def ordered(hashes: np.ndarray, df: np.ndarray, sizes: np.ndarray, once: np.ndarray) -> list[pa.Array]:
        """The columns behind the sums, for some sets: what the first prefix shows to be shared, for those that are ``once``."""
        of = np.repeat(np.arange(len(sizes)), sizes)
        length = sizes - -(-percent * sizes // 100) + 1

        def prefix(of: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Places of the tokens in their set's order, and which of them are in its prefix."""
            place, first = np.empty(len(of), np.int64), np.searchsorted(of, of)
            place[order] = np.arange(len(of)) - first
            return place, place < length[of]

        # the hashes of a set are sorted: a stable sort by frequency leaves them so
        at, inside = prefix(of, np.argsort(of * 256 + df, kind="stable"))
        open_ = np.zeros(len(sizes), bool)
        open_[of[inside & (df > 1)]] = True
        open_ &= once
        columns = []
        # the other orders, for the sets that need them
        some = open_[of]
        hashes, of, df, at, inside = hashes[some], of[some], df[some], at[some], inside[some]
        rare = np.log2(np.maximum(df, 1)).astype(np.int64)
        _, second = prefix(of, np.lexsort((hs.mix(hashes + np.uint64(11)), rare, of)))
        _, third = prefix(of, np.lexsort((hs.mix(hashes + np.uint64(12)), of)))
        known = df > 1
        for mask, values in ((known, hashes), (known & inside, hashes), (known & inside, at), (known & second, hashes), (known & third, hashes)):
            offsets = np.concatenate(([0], np.cumsum(np.bincount(of[mask], minlength=len(sizes)))))
            values = pa.array(values[mask].view(np.int64)) if values is hashes else pa.array(values[mask].astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            columns.append(pc.if_else(pa.array(open_), lists, pa.scalar(None, lists.type)))
        # bitmaps of the shared tokens, for the sets that need them
        numbers = np.flatnonzero(open_)
        words, hidden = bitmaps(hashes[known], np.searchsorted(numbers, of[known]), len(numbers))
        offsets = np.concatenate(([0], np.cumsum(open_ * WORDS)))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(words.reshape(-1)))
        columns.append(pc.if_else(pa.array(open_), lists, pa.scalar(None, lists.type)))
        spare = np.zeros(len(sizes), np.int64)
        spare[numbers] = hidden
        return [*columns, pa.array(spare)]

    form = ch.kinds(_SCHEMA)
    asked = ch.ask(packed, question, "bucket int, keys binary, counts binary")
    return ch.meet(packed, ch.answer(asked, _frequencies, "df binary"), use, _SCHEMA)


def _linked_rows(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row its id, text_key, n_shingles, node (its class; null without words) and component (a node)."""
    rows = saved(signatures(docs, n, percent, id_col, text_col)).withColumn("node", F.when(F.col("n_shingles") > 0, F.xxhash64("n_shingles", "s1", "s2")))
    # a class has its lists once in each chunk: any of them, they are alike
    lists = ("n_shingles", "shared", "p1", "at1", "p2", "p3", "words", "spare")
    sets = rows.where("shared IS NOT NULL").groupBy("node").agg(F.any_value(F.struct(*lists)).alias("x"))
    sets = saved(sets.select("node", F.col("x.n_shingles").alias("n"), *(f"x.{c}" for c in lists[1:])))

    def near(x, y):
        # what two sets can share from their first common token on
        rest = F.least(x("n") - x("at"), y("n") - y("at"))
        return (100 + percent) * rest >= percent * (x("n") + y("n"))

    def verify(pairs: DataFrame) -> DataFrame:
        # first the other orders' prefixes, then the sets of the pairs that are left
        filters, tokens = sets.select("node", "p2", "p3"), sets.select("node", "n", "shared")
        both = pairs.join(filters.toDF("a", "p2_a", "p3_a"), "a").join(filters.toDF("b", "p2_b", "p3_b"), "b")
        both = both.where(F.arrays_overlap("p2_a", "p2_b") & F.arrays_overlap("p3_a", "p3_b")).select("a", "b")
        both = both.join(tokens.toDF("a", "n_a", "s_a"), "a").join(tokens.toDF("b", "n_b", "s_b"), "b")
        common = F.size(F.array_intersect("s_a", "s_b"))
        return both.where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")

    prefix = F.explode(F.arrays_zip("p1", "at1")).alias("x")
    postings = sets.select("node", "n", prefix).select(F.col("x.p1").alias("key"), "node", "n", F.col("x.at1").alias("at"))
    found = linked_groups(postings, verify, sketch(sets, "n", "spare", "words"), percent, near)
    return rows.select("doc_id", "text_key", "n_shingles", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def join(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every row."""
    rows = _linked_rows(docs, n, percent, id_col, text_col)
    # the sums combine before the shuffle: a component of a third of all rows costs no task more
    names = rows.where("node IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("name"))
    out = rows.join(names, "component", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, of which each stands for its component: of every group of linked documents
    the one of smallest id (null last; of two texts of one id any, but always the same). Rows without words all stay, but of rows
    with equal id and text one."""
    rows = _linked_rows(docs, n, percent, id_col, text_col)
    first = F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    best = rows.where("node IS NOT NULL").groupBy("component").agg(first.alias("best")).select("component", "best.*")
    # every row of the chosen id and text, counted: rows of one id and text are the exception
    chosen = rows.join(best.select("component", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "component", "left")
    chosen = chosen.where(F.col("node").isNull() | (F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))))
    kept = chosen.groupBy(F.col("doc_id").alias("_kept"), F.col("text_key").alias("_text_key")).agg(F.count("*").alias("_rows"))
    kept = saved(kept)

    def of(which: DataFrame) -> DataFrame:
        same = docs[id_col].cast("long").eqNullSafe(which["_kept"]) & (_text_key(text_col) == which["_text_key"])
        return docs.join(which, same, "left_semi")

    return of(kept.where("_rows = 1")).unionByName(of(kept.where("_rows > 1")).dropDuplicates([id_col, text_col]))
