"""Fuzzy line deduplication: MinHash over character shingles, exact verification, one line kept per component.

A line is a \\n-split part of a text with a character other than space, tab, vertical tab, form feed and carriage
return; it is compared without those at its ends. Equal lines are one node. Two lines link when the Jaccard
similarity of their sets of 5-character shingles is ``PERCENT`` % or more (shorter lines: the line is the one shingle).
Of each component of linked lines the earliest line stays (smallest id, then place in its text); all others are
removed with their line ends. Other lines stay as they are.

Candidates come from MinHash signatures of ``BANDS`` x ``ROWS`` values: one permutation, whose hashes fall into
that many bins; a bin without a shingle takes the value of another. Short lines take a permutation per value. A pair of 75 % shares
a band with probability 0.9990 (measured at 75 to 76 %: 0.999), one of 80 % with 0.99999, one of 20 % with 0.0006: many lines
have a fifth in common. Lines that share a band meet through hubs (``components.linked_sets``) and are verified on their shingles, told apart
within a pair by the first bits of their hashes, 40 or more.

A chunk sends each of its distinct lines' bands once, as the first bits of their hashes with the line's number in the chunk and
16 bits that tell lines apart. The answer names the lines that share a band with another one, with a fingerprint of the set of lines and
its first line, the hub: bands of the same lines become one key, and the line chooses the hub it shares most bands with. Only those lines'
texts travel further.

A null text has no lines and stays null; an empty one stays empty. Rows with equal ids are ordered by their text.
Null ids come first. Lines are identified by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carbonloom.llm import chunks as ch
from carbonloom.llm import hashing as hs
from carbonloom.llm.components import WORDS, bitmaps, linked_sets, saved, sketch
from carbonloom.llm.shared import let_go, stored

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 48, 7
_BLANKS = b" \t\x0b\x0c\r"


class Lines:
    """The lines with a word of a chunk's texts, in order: their text's number, their number in it, hash and bytes without blanks."""

    def __init__(self, texts: pa.Table):
        ids = texts["id"].combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
        # equal ids stand together, in order of text: their line numbers go on
        rank = np.arange(len(ids)) - np.searchsorted(ids, ids)
        #: All parts of each text, with and without words.
        self.parts = [x.split(b"\n") for x in texts["text"].cast(pa.large_binary()).to_pylist()]
        self.bare: list[bytes] = []
        text, number = [], []
        for t, parts in enumerate(self.parts):
            for i, part in enumerate(parts):
                line = part.strip(_BLANKS)
                if line:
                    self.bare.append(line)
                    text.append(t)
                    number.append(i)
        digest = xxhash.xxh3_64_intdigest
        self.node = np.array([digest(x) for x in self.bare], np.uint64).view(np.int64)
        self.text, self.number = np.array(text, np.int64), np.array(number, np.int64)
        self.doc = ids[self.text]
        # its place in the text tells lines apart and orders them
        self.at = self.number + (rank[self.text].astype(np.int64) << 40)

    def distinct(self) -> np.ndarray:
        """One place of each line: the first, in order."""
        return np.sort(np.unique(self.node, return_index=True)[1])


#: Lines of fewer shingles take a permutation per value; one permutation would leave most of their bins empty.
FEW = 64
#: Bytes of lines whose arrays are worked on together.
_PIECE = 512 << 10
#: Turns of filling empty bins that look at all bins.
_DENSE = 3
_BITS = np.uint64(32)
_LOW = np.uint32(0xFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every shingle of the lines, its line, and where each line's shingles begin (and the end)."""
    data = b"".join(lines)
    plain = data.isascii()
    codes = np.frombuffer(data, np.uint8) if plain else np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    if plain:
        sizes = np.array([len(x) for x in lines], np.int64)
    else:
        lead = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
        sizes = np.diff(lead[np.concatenate(([0], np.cumsum([len(x) for x in lines])))])
    ends = np.cumsum(sizes)
    total = codes.astype(np.uint64)
    total += np.uint64(1)
    for j in range(1, SHINGLE):
        # a place near the end of the last line reads no further than the codes
        total *= _STEP
        total[:-j] += codes[j:]
    counts = np.maximum(sizes - SHINGLE + 1, 1)
    begin = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(np.arange(len(lines)), counts)
    # the last places of a line begin no shingle, but its first one always does
    last = np.concatenate([(ends - j)[sizes > j] for j in range(1, SHINGLE)])
    whole = np.ones(len(codes), bool)
    whole[last] = False
    out = hs.mix(total[whole])
    short = np.flatnonzero(sizes < SHINGLE)
    if len(short):  # their one place has read into the next line
        out[begin[short]] = [xxhash.xxh3_64_intdigest(lines[i]) for i in short]
    return out, owner, begin


@cache
def _pick(bins: int, turn: int) -> np.ndarray:
    return (hs.mix(np.arange(bins, dtype=np.uint64) + np.uint64(1000 * (turn + 1))) % np.uint64(bins)).astype(np.int64)


def _least(hashes: np.ndarray, owner: np.ndarray, begin: np.ndarray, bins: int) -> np.ndarray:
    """(lines x bins) minima: of one permutation per bin for short lines, else of one permutation cut into bins."""
    n = len(begin) - 1
    few = np.diff(begin) < FEW
    # all hashes at once; short lines are done again below
    least = np.full(n * bins, _LOW, np.uint32)
    to = hashes >> _BITS
    to *= np.uint64(bins)
    to >>= _BITS
    to += np.repeat(np.arange(n, dtype=np.uint64) * np.uint64(bins), np.diff(begin))
    np.minimum.at(least, to.view(np.int64), hashes.astype(np.uint32))
    rows = least.reshape(n, bins)
    if few.any():
        some = few[owner]
        seeds = hs.mix(np.arange(1, bins + 1, dtype=np.uint64))
        own, first = hashes[some], ch.runs(owner[some])
        anew, values = np.empty_like(own), np.empty((bins, len(first)), np.uint64)
        for k in range(bins):
            # one multiplication by an odd number and the high half: enough to order the same hashes anew
            np.bitwise_xor(own, seeds[k], out=anew)
            np.multiply(anew, seeds[k] | np.uint64(1), out=anew)
            np.minimum.reduceat(anew, first, out=values[k])
        rows[few] = short = (values >> _BITS).astype(np.uint32).T
    # an empty bin takes the value of the first filled one of a sequence that is random, and its own
    source = least.copy()
    for turn in range(_DENSE):  # as long as many bins are empty, all are looked at
        rows = np.where(rows == _LOW, source.reshape(n, bins).take(_pick(bins, turn), axis=1), rows)
    least = rows.reshape(-1)
    empty = np.flatnonzero(least == _LOW)
    column = empty % bins
    begin = empty - column
    for turn in range(_DENSE, 8 * bins):
        if not len(empty):
            break
        value = source.take(begin + _pick(bins, turn).take(column))
        least[empty] = value  # what is empty still is met again
        left = np.flatnonzero(value == _LOW)
        empty, column, begin = empty.take(left), column.take(left), begin.take(left)
    if few.any():
        rows[few] = short
    return rows


def _pieces(lines: list[bytes]) -> Iterator[tuple[int, int]]:
    yield from hs.pieces(np.concatenate(([0], np.cumsum([len(x) for x in lines], dtype=np.int64))), _PIECE)


def _banded(lines: list[bytes], bands: int = BANDS, rows: int = ROWS) -> Iterator[tuple[int, int, np.ndarray]]:
    """Pieces of the lines, as from and to, with their (lines x bands) band hashes."""
    for a, b in _pieces(lines):
        least = _least(*_hashes(lines[a:b]), bands * rows)
        total = np.zeros((b - a, bands), np.uint64)
        for r in range(rows):  # the values of a band stand far apart
            total = (total + least[:, r * bands : (r + 1) * bands]) * _STEP
            total ^= total >> np.uint64(29)
        yield a, b, hs.mix(total + np.arange(bands, dtype=np.uint64))


def signatures(lines: list[bytes], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(lines x bands) band hashes; worked on in pieces of bytes."""
    return np.concatenate([np.zeros((0, bands), np.uint64), *(x for _, _, x in _banded(lines, bands, rows))])


def shingle_set(line: bytes) -> frozenset[str]:
    text = line.decode("utf-8", "surrogatepass")
    return frozenset(text[i : i + SHINGLE] for i in range(max(len(text) - SHINGLE + 1, 1)))


def _distinct(lines: list[bytes]) -> tuple[np.ndarray, np.uint64]:
    """The lines' distinct shingles in order, as the line's number before the first bits of the shingle's hash: one sort finds them.
    Also the bits of the number."""
    low = np.uint64(len(lines).bit_length())
    hashes, owner, _ = _hashes(lines)
    keys = owner.astype(np.uint64) << (np.uint64(64) - low) | hashes >> low
    keys.sort()
    return keys[ch.runs(keys)], low


def alike(x: list[bytes], y: list[bytes], percent: int = PERCENT) -> np.ndarray:
    """Whether the shingles of each line of ``x`` and the line of ``y`` beside it are ``percent`` alike."""
    keep = np.zeros(len(x), bool)
    for a, b in _pieces([p + q for p, q in zip(x, y)]):
        (one, low), (other, _) = _distinct(x[a:b]), _distinct(y[a:b])
        both = np.sort(np.concatenate((one, other)), kind="stable")  # merges the two
        common, *sizes = (
            np.bincount((keys >> (np.uint64(64) - low)).astype(np.int64), minlength=b - a) for keys in (both[1:][both[1:] == both[:-1]], one, other)
        )
        keep[a:b] = 100 * common >= percent * (sum(sizes) - common)
    return keep


def _sketches(lines: list[bytes]) -> tuple[list[int], list[int], list[list[int]]]:
    return tuple(x.tolist() for x in _sketched(lines))


def _sketched(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of distinct shingles, of those hidden in the bitmap, and the bitmap of each line."""
    sizes, spare = np.zeros(len(lines), np.int32), np.zeros(len(lines), np.int32)
    words = np.zeros((len(lines), WORDS), np.int64)
    for a, b in _pieces(lines):
        keys, low = _distinct(lines[a:b])
        owner = (keys >> (np.uint64(64) - low)).astype(np.int64)
        sizes[a:b] = np.bincount(owner, minlength=b - a)
        words[a:b], spare[a:b] = bitmaps(keys << low, owner, b - a)
    return sizes, spare, words


#: What a line's chunk is told of a band that it shares: the line's number, the first line of the band (chunk << 32 | number), and how many it has.
_SHARED = np.dtype([("number", "<i4"), ("hub", "<i8"), ("size", "<i4")])


def _sorted(keys: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in order, equal ones as they stand, and the keys in order. The first ``spare`` bits of the keys are 0."""
    places = np.uint64(len(keys).bit_length())
    if places > spare:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    # a key and its place are one number: sorting it is faster than sorting places
    keys = keys << places
    keys |= np.arange(len(keys), dtype=np.uint64)
    keys.sort()
    return (keys & ((np.uint64(1) << places) - np.uint64(1))).astype(np.int64), keys >> places


def _shared_bands(blocks: list[dict]) -> list[tuple]:
    """For the blocks of a bucket: the bands that different lines share, as (chunk, fingerprints of their sets of lines, :data:`_SHARED`);
    of equal lines in several chunks the one of the smallest chunk. Also, by chunk, the lines (hashes) of several chunks."""
    blocks = sorted(blocks, key=lambda b: b["chunk"])
    lines = [ch.get_keys(b["lines"]) for b in blocks]
    every = np.sort(np.concatenate(lines))
    every = every[1:][every[1:] == every[:-1]]  # a chunk names a line once
    again = [(b["chunk"], b"", b"", own[np.isin(own, every)].view(np.int64).tolist()) for b, own in zip(blocks, lines)] if len(every) else []
    blocks = [b for b in blocks if b["keys"]]
    if not blocks:
        return again
    keys = np.concatenate([ch.get_keys(b["keys"]) for b in blocks])
    tags = np.concatenate([ch.get(b["tags"], np.uint16) for b in blocks])
    numbers = np.concatenate([ch.get_planes(b["numbers"], np.int32) for b in blocks])
    chunk = np.repeat(np.array([b["chunk"] for b in blocks], np.int32), [len(ch.get(b["tags"], np.uint16)) for b in blocks])
    order, ranked = _sorted(keys, 64 - int(keys.max()).bit_length())  # in order of chunk within a key
    same = ranked[1:] == ranked[:-1]
    alone = ~(np.append(same, False) | np.insert(same, 0, False))
    order, ranked = order[~alone], ranked[~alone]  # most bands are of one line only: the rest is sorted further
    if not len(order):
        return again
    # by key, then tag, in one number; equal ones stay in order of chunk
    keys = np.cumsum(np.insert(ranked[1:] != ranked[:-1], 0, False)).astype(np.uint64) << np.uint64(16) | tags[order]
    place, keys = _sorted(keys, 64 - int(keys.max()).bit_length())
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    order, keys = order[place[new]], keys[new] >> np.uint64(16)
    numbers, chunk = numbers[order], chunk[order]
    size = np.diff(np.append(ch.runs(keys), len(keys)))
    some = np.repeat(size > 1, size)
    size, numbers, chunk = size[size > 1], numbers[some], chunk[some]
    if not len(size):
        return again
    told, line = np.empty(len(chunk), _SHARED), chunk.astype(np.int64) << 32 | numbers
    begin = np.cumsum(size) - size
    told["number"], told["hub"], told["size"] = numbers, np.repeat(np.minimum.reduceat(line, begin), size), np.repeat(size, size)
    sets = np.repeat(hs.mix(np.add.reduceat(hs.mix(line.view(np.uint64) + _STEP), begin) + size.astype(np.uint64)), size)
    order = np.argsort(chunk, kind="stable")
    cuts = ch.runs(chunk[order])
    each = [(int(chunk[order[a]]), order[a:b]) for a, b in zip(cuts, [*cuts[1:], len(order)])]
    found = [(c, ch.put(sets[own]), ch.put_planes(told[own]), []) for c, own in each]
    return found + again


def _question(buckets: int):
    """A chunk's bands by bucket: keys, and per key the line's number in the chunk and 16 bits of the line; and its lines' hashes by
    bucket."""
    # the first bits of a hash: a few false candidates are cheaper than long keys
    cut = np.uint64(max(0, 64 - 8 - (buckets << 22).bit_length()))

    def run(texts: pa.Table) -> list[tuple]:
        t = Lines(texts)
        some = t.distinct()
        keys, tags, node = np.empty(len(some) * BANDS, np.uint64), np.empty(len(some) * BANDS, np.uint16), t.node[some].view(np.uint64)
        for a, b, bands in _banded([t.bare[i] for i in some]):
            own = slice(a * BANDS, b * BANDS)
            keys[own] = (bands >> cut).reshape(-1)
            tags[own] = (hs.mix(node[a:b, None] + bands) >> np.uint64(48)).astype(np.uint16).reshape(-1)
        order, keys = _sorted(keys, cut)
        cuts = ch.bucket_cuts(keys << cut, buckets)
        node.sort()
        at = ch.bucket_cuts(node, buckets)
        return [
            (i, ch.put_keys(keys[a:b]), ch.put_planes((order[a:b] // BANDS).astype(np.int32)), ch.put(tags[order[a:b]]), ch.put_keys(node[x:y]))
            for i, (a, b, x, y) in enumerate(zip(cuts, cuts[1:], at, at[1:]))
            if b > a or y > x
        ]

    return run


def _hubs(told: np.ndarray, sets: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk's answers: the lines' numbers, for each the hub it shares most bands with (-1: none but itself), and its distinct open
    sets, with where each line's begin (and the end). A set of two lines that its hub settles is not open."""
    numbers, line = np.unique(told["number"], return_inverse=True)
    away = told["hub"] != (np.int64(chunk) << 32 | told["number"])
    of, hub = line[away], told["hub"][away]
    order = np.lexsort((hub, of))
    of, hub = of[order], hub[order]
    first = np.flatnonzero(np.diff(of, prepend=-1) | np.diff(hub, prepend=-1))
    often = np.diff(np.append(first, len(of)))
    of, hub = of[first], hub[first]
    order = np.lexsort((hub, -often, of))
    order = order[ch.runs(of[order])]
    best = np.full(len(numbers), -1, np.int64)
    best[of[order]] = hub[order]
    open_ = (told["size"] > 2) | (told["hub"] != best[line])
    line, sets = line[open_], sets[open_]
    order = np.lexsort((sets, line))
    line, sets = line[order], sets[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (sets[1:] != sets[:-1])
    return numbers, best, sets[new].view(np.int64), np.searchsorted(line[new], np.arange(len(numbers) + 1))


_LINE = (
    "node long, line binary, id long, hub long, keys array<long>, size int, spare int, words array<long>, "
    "chunk int, nodes array<long>, doc array<long>, at array<long>, n array<long>"
)


def dedup(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, drop_emptied: bool = False
) -> DataFrame:
    """Every row with its columns, its text without the removed lines; with ``counts``, its id, text, n_lines and
    n_removed instead. ``drop_emptied`` leaves out rows that had lines and have lost them all."""
    buckets = ch.chunk_count(docs)
    extra = () if counts else tuple(c for c in docs.columns if c not in (id_col, text_col))
    packed = ch.pack(docs, id_col, text_col, buckets, F.col(text_col).isNull(), extra)

    asked = ch.ask(packed, _question(buckets), "bucket int, keys binary, numbers binary, tags binary, lines binary")
    told = "chunk int, sets binary, lines binary, again array<long>"
    reply = ch.kinds(told)

    def answer(blocks: pa.Table) -> pa.Table:
        rows = _shared_bands(blocks.to_pylist())
        hs.give_back()
        return ch.table(rows, reply)

    shared = asked.groupBy("bucket").applyInArrow(answer, told)

    # in one pass over the chunks: the texts of the lines that share a band, and the first place and the number of
    # every distinct line that shares one or occurs again; the others stay, whatever becomes of the rest
    def lines_of(texts: pa.Table, replies: pa.Table) -> pa.Table:
        t = Lines(texts)
        names, first, number = np.unique(t.node, return_index=True, return_counts=True)
        some = np.sort(first)
        chunk, parts = ch.chunk_of(texts), replies.select(["sets", "lines"]).to_pydict()
        sets = np.concatenate([np.zeros(0, np.uint64), *(ch.get(x, np.uint64) for x in parts["sets"] if x)])
        told = np.concatenate([np.zeros(0, _SHARED), *(ch.get_planes(x, _SHARED) for x in parts["lines"] if x)])
        asked, hub, sets, begin = _hubs(told, sets, chunk)
        bare = [t.bare[some[i]] for i in asked]
        of_line = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(sets))
        size, spare, words = _sketched(bare)
        words = pa.ListArray.from_arrays(pa.array(np.arange(len(bare) + 1) * WORDS, pa.int32()), pa.array(words.reshape(-1)))
        values = (t.node[some[asked]], bare, np.int64(chunk) << 32 | asked, pa.array(hub, mask=hub < 0), of_line, size, spare, words)
        found = [x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(values, form)]
        again = replies["again"].combine_chunks().flatten().to_numpy()
        open_ = (number > 1) | np.isin(names, again) | np.isin(names, t.node[some[asked]])
        names, first, number = names[open_], first[open_], number[open_]
        own = [[None] * 8 + [chunk, names.tolist(), t.doc[first].tolist(), t.at[first].tolist(), number.tolist()]]
        none = [pa.nulls(len(asked), kind) for kind in form.types[len(found) :]]
        return pa.concat_tables([pa.Table.from_arrays(found + none, schema=form), ch.table(own, form)])

    form = ch.kinds(_LINE)
    both = stored(ch.meet(packed, shared, lines_of, _LINE), "lines")
    let_go(docs.sparkSession)  # the bands' shuffles: they would else lie beside those of the groups
    found = both.where("line IS NOT NULL")
    texts = found.select("id", "line", "size")
    postings = found.select(F.explode("keys").alias("key"), F.col("id").alias("node"), "size")
    hubs = found.where("hub IS NOT NULL").select(F.col("id").alias("a"), F.col("hub").alias("b"), F.col("line").alias("x"), F.col("size").alias("size_x"))
    exploded = F.explode(F.arrays_zip(F.col("nodes").alias("node"), "doc", "at", "n")).alias("x")
    lines = both.where("nodes IS NOT NULL").select("chunk", exploded).select("chunk", "x.*")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = alike(batch.column("x").to_pylist(), batch.column("y").to_pylist(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def verify(pairs: DataFrame) -> DataFrame:
        x, y = texts.toDF("a", "x", "size_x"), texts.toDF("b", "y", "size_y")
        both = (pairs if "x" in pairs.columns else pairs.join(x, "a")).join(y, "b")
        both = both.where(near(lambda c: F.col(f"{c}_x"), lambda c: F.col(f"{c}_y")))
        return both.select("a", "b", "x", "y").mapInArrow(verified, "a long, b long")

    def near(x, y) -> Column:
        # sets of more different sizes cannot be that similar
        return 100 * F.least(x("size"), y("size")) >= percent * F.greatest(x("size"), y("size"))

    sketches = sketch(found.withColumn("node", F.col("id")), "size", "spare", "words")
    linked = linked_sets(postings, hubs, verify, sketches, percent, near, buckets).toDF("id", "linked")
    linked = found.select("id", "node").join(linked, "id").select("node", "linked")

    # the earliest line of each component, among all lines; only lines that occur again, alike or equal, need an answer
    every = F.collect_list("chunk").alias("chunks")
    firsts = lines.groupBy("node").agg(F.min(F.struct("doc", "at")).alias("first"), F.sum("n").alias("n"), every)
    firsts = firsts.join(linked, "node", "left").where("n > 1 OR linked IS NOT NULL")
    firsts = saved(firsts.select("node", "first", "n", "chunks", F.struct(F.col("linked").isNull(), F.coalesce("linked", "node")).alias("component")))
    best = firsts.groupBy("component").agg(F.min("first").alias("best"))
    kept = firsts.join(best, "component").where("n > 1 OR first <> best")
    answers = kept.select(F.explode("chunks").alias("chunk"), "node", F.col("best.doc").alias("doc"), F.col("best.at").alias("at"))

    def cut(texts_: pa.Table, winners: pa.Table) -> pa.Table:
        t = Lines(texts_)
        nodes = winners["node"].to_numpy() if winners.num_rows else np.zeros(0, np.int64)
        order = np.argsort(nodes)
        nodes = nodes[order]
        at = np.minimum(np.searchsorted(nodes, t.node), max(len(nodes) - 1, 0))
        gone = np.zeros(len(t.node), bool)
        if len(nodes):
            doc, place = winners["doc"].to_numpy()[order], winners["at"].to_numpy()[order]
            gone = (nodes[at] == t.node) & ((doc[at] != t.doc) | (place[at] != t.at))
        removed = np.bincount(t.text[gone], minlength=len(t.parts))
        without = {}
        for i, number in zip(t.text[gone].tolist(), t.number[gone].tolist()):
            without.setdefault(i, set()).add(number)
        kept_parts = (
            [x for j, x in enumerate(parts) if j not in without[i]] if i in without else parts for i, parts in enumerate(t.parts)
        )
        text = [None if none else b"\n".join(parts) for none, parts in zip(texts_["flag"].to_pylist(), kept_parts)]
        return pa.table(
            {
                "id": texts_["id"],
                "text": pa.array(text, pa.binary()).cast(pa.string()),
                **{f"e{i}": texts_[f"e{i}"] for i in range(len(extra))},
                "n_lines": pa.array(np.bincount(t.text, minlength=len(t.parts)).astype(np.int64)),
                "n_removed": pa.array(removed.astype(np.int64)),
            }
        )

    kinds = "".join(f"e{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(extra))
    out = ch.meet(packed, answers, cut, f"id long, text string, {kinds}n_lines long, n_removed long")
    if drop_emptied:
        out = out.where("n_lines = 0 OR n_removed < n_lines")
    if counts:
        return out.withColumnRenamed("id", id_col)
    own = {id_col: F.col("id").cast(docs.schema[id_col].dataType), text_col: F.col("text")}
    own |= {c: F.col(f"e{i}") for i, c in enumerate(extra)}
    return out.select(*(own[c].alias(c) for c in docs.columns))
