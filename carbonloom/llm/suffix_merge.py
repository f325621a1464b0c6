"""Exact removal of repeated 100-byte strings: sorted suffix runs, front-coded, merged without re-comparing prefixes.

Every byte covered by a string of ``SPAN`` bytes that also starts earlier (smaller id, or same text and earlier
start) is removed. Strings are judged on the input, overlaps count, matches never cross texts.

Every window of ``SPAN`` bytes has an anchor, the leftmost of its ``SEED``-byte strings of least hash. Equal windows
have equal anchors at equal places, so only suffixes that start at anchors (about one byte in 35) are sorted,
and an anchor answers for the windows it is the anchor of, its context. Three passes over the texts:

1. Fingerprints. Each chunk sends one fingerprint per distinct context and per distinct seed. A context met earlier
   is a repeat as a whole; a seed with one context everywhere has no other repeats. Both need no sorting.
2. Merge sort. What is left are contexts that share a seed but differ somewhere, at the ends of repeats. Their
   suffixes go out as sorted runs, front-coded (length of the prefix shared with the suffix before, and the rest). A
   loser tree merges the runs of a key range; it compares two suffixes only beyond what both are known to
   share with the last one out, and yields the common prefix lengths of all neighbours. With the same for the
   reversed text before the anchor, equal windows are runs in two sorted orders.
3. The chunks mark and cut the bytes.

A seed with more than ``hot`` contexts (a passage at whose ends everything differs) is not merged in one task: its
windows are fingerprinted one by one, which spreads them over all tasks and combines equal ones per chunk first.

Fingerprints have 96 bits. Texts are UTF-8; a null or short text loses nothing. Rows with equal ids are ordered by their
text. Null ids come first. Columns beside id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from carbonloom.llm import chunks as ch
from carbonloom.llm import hashing as hs
from carbonloom.llm.components import saved

SPAN = 100
SEED = 32
OFFSETS = SPAN - SEED + 1
HOT = 50_000
_PIECE = 512 << 10
CONTEXTS, SEEDS, RUNS, WINDOWS = 0, 1, 2, 3
#: Answers: nothing more to do; repeat as a whole; goes into the merge sort; its windows go one by one.
DONE, REPEAT, MERGE, SINGLE = 0, 1, 2, 3


def _sliding(values: np.ndarray, n: int, op) -> np.ndarray:
    """``op`` over every n neighbours, by doubling; n - 1 values fewer."""
    width, out = 1, values
    while width * 2 <= n:
        out, width = op(out[:-width], out[width:]), width * 2
    rest = n - width
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places in ``data``, in order, with the first and last window start they are the anchor of."""
    places, lows, highs = [], [], []
    for a, b in hs.pieces(offsets, _PIECE):
        base, end = offsets[a], offsets[b]
        if end - base < SPAN:
            continue
        part = data[base:end]
        n = len(part)
        sums = hs.Running(part).sums
        seed = hs.mix((sums[SEED:] - sums[:-SEED]) * hs._power("down", hs._INVERSE, n + 1)[: n + 1 - SEED])
        least = _sliding(seed, OFFSETS, np.minimum)  # by window start
        # a place is an anchor's if its value is the least of some window that holds it
        most = _sliding(np.concatenate((np.zeros(OFFSETS - 1, np.uint64), least, np.zeros(OFFSETS - 1, np.uint64))), OFFSETS, np.maximum)
        candidate = np.flatnonzero(seed == most)
        # windows inside one text
        start = offsets[a:b] - base
        stop = offsets[a + 1 : b + 1] - base - SPAN + 1
        change = np.zeros(len(least) + 1, bool)
        change[1:-1] = least[1:] != least[:-1]
        change[candidate[candidate + 1 < len(change)] + 1] = True
        change[start[start < len(change)]] = True
        edge = stop[(stop > 0) & (stop < len(change))]
        change[edge] = True
        change[0] = True
        first = np.flatnonzero(change[:-1])
        last = np.append(first[1:], len(least)) - 1
        owner = np.searchsorted(start, first, side="right") - 1
        # empty texts share a start: the last of them holds the bytes
        inside = first < stop[owner]
        first, last = first[inside], last[inside]
        at = np.searchsorted(candidate, first)
        wrong = np.flatnonzero(seed[candidate[at]] != least[first])
        while len(wrong):
            at[wrong] += 1
            wrong = wrong[seed[candidate[at[wrong]]] != least[first[wrong]]]
        place = candidate[at]
        begin = ch.runs(place)
        places.append(place[begin] + base)
        lows.append(first[begin] + base)
        highs.append(last[np.append(begin[1:], len(place)) - 1] + base)
    empty = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or empty).astype(np.int64) for x in (places, lows, highs))


class Anchored:
    """A chunk's anchors in order of text and place, and their fingerprints."""

    def __init__(self, texts: pa.Table):
        self.data, self.offsets = hs.buffers(texts["text"])
        self.place, self.low, self.high = anchors(self.data, self.offsets)
        self.text = np.searchsorted(self.offsets, self.place, side="right") - 1
        ids = texts["id"].combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
        self.id = ids[self.text]
        # equal ids stand together, in order of text: their places go on
        rank = np.arange(len(ids)) - np.searchsorted(ids, ids)
        self.at = self.place - self.offsets[self.text] + (rank[self.text].astype(np.int64) << 40)
        self.seed, self.context, self.check = self._fingerprints()

    def _fingerprints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = [np.zeros(len(self.place), np.uint64) for _ in range(3)]
        shape = ((self.place - self.low) * 128 + (self.high - self.place + 128)).astype(np.uint64)
        for a, b in hs.pieces(self.offsets):
            base, end = self.offsets[a], self.offsets[b]
            some = slice(np.searchsorted(self.place, base), np.searchsorted(self.place, end))
            if some.stop == some.start:
                continue
            running, second = hs.Running(self.data[base:end]), hs.Running(self.data[base:end] ^ 0xA5)
            low, high, place = self.low[some] - base, self.high[some] - base + SPAN, self.place[some] - base
            out[0][some] = running.of(place, place + SEED)
            out[1][some] = hs.mix(running.of(low, high) ^ hs.mix(shape[some]))
            out[2][some] = second.of(low, high)
        return out[0], out[1], out[2].astype(np.uint32)

    def window_keys(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All windows of the given anchors: the anchor, the window's start and its fingerprint."""
        sizes = self.high[anchor] - self.low[anchor] + 1
        of = np.repeat(anchor, sizes)
        start = np.repeat(self.low[anchor], sizes) + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = np.zeros(len(of), np.uint64)
        for a, b in hs.pieces(self.offsets):
            base, end = self.offsets[a], self.offsets[b]
            some = np.flatnonzero((start >= base) & (start < end))
            if len(some):
                keys[some] = hs.Running(self.data[base:end]).of(start[some] - base, start[some] - base + SPAN)
        return of, start, keys


def _firsts(keys: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries that are the first of their key, in order of key; and for every entry whether it is."""
    order = np.lexsort((np.arange(len(keys)), *more, keys))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        for m in more:
            new[1:] |= m[order[1:]] != m[order[:-1]]
    first = np.zeros(len(keys), bool)
    first[order[new]] = True
    return order[new], first


def _blocks(kind: int, buckets: int, keys: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """``keys`` sorted, cut by bucket."""
    cuts = ch.bucket_cuts(keys, buckets)
    return [(kind * buckets + i, ch.put_keys(keys[a:b]), [ch.put(v[a:b]) for v in values]) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _ask_fingerprints(t: Anchored, buckets: int) -> list[tuple]:
    some, _ = _firsts(t.context, t.check)
    rows = _blocks(CONTEXTS, buckets, t.context[some], t.check[some], t.id[some], t.at[some])
    # distinct contexts per seed: their number, and the only one's fingerprint
    seeds = t.seed[some]
    order = np.argsort(seeds, kind="stable")
    begin = ch.runs(seeds[order])
    number = np.diff(np.append(begin, len(order))).astype(np.uint32)
    one = np.where(number == 1, t.context[some][order[begin]] if len(begin) else 0, 0).astype(np.uint64)
    return rows + _blocks(SEEDS, buckets, seeds[order[begin]], number, one)


def _split(order_values: np.ndarray, keys: list[np.ndarray], blocks: list[dict]) -> list[tuple]:
    out, at = [], 0
    for block, own in zip(blocks, keys):
        out.append((block["chunk"], ch.put(order_values[at : at + len(own)])))
        at += len(own)
    return out


def _earliest(blocks: list[dict], checked: bool) -> list[tuple]:
    """For contexts or windows: REPEAT for all but the earliest of each key."""
    keys = [ch.get_keys(b["keys"]) for b in blocks]
    kinds = (np.uint32, np.int64, np.int64) if checked else (np.int64, np.int64)
    values = [np.concatenate([ch.get(b["values"][i], k) for b in blocks]) for i, k in enumerate(kinds)]
    every = np.concatenate(keys)
    order = np.lexsort((values[-1], values[-2], *values[:-2], every))
    same = np.zeros(len(order), bool)
    same[1:] = every[order[1:]] == every[order[:-1]]
    if checked:
        same[1:] &= values[0][order[1:]] == values[0][order[:-1]]
    out = np.zeros(len(order), np.uint8)
    out[order] = np.where(same, REPEAT, DONE)
    return _split(out, keys, blocks)


def _several(blocks: list[dict], hot: int) -> list[tuple]:
    """For seeds: MERGE or SINGLE where there is more than one context."""
    keys = [ch.get_keys(b["keys"]) for b in blocks]
    every = np.concatenate(keys)
    number = np.concatenate([ch.get(b["values"][0], np.uint32) for b in blocks]).astype(np.int64)
    one = np.concatenate([ch.get(b["values"][1], np.uint64) for b in blocks])
    order = np.argsort(every, kind="stable")
    begin = ch.runs(every[order])
    total = np.add.reduceat(number[order], begin)
    differ = (np.maximum.reduceat(one[order], begin) != np.minimum.reduceat(one[order], begin)) | (np.maximum.reduceat(number[order], begin) > 1)
    found = np.where(differ, np.where(total > hot, SINGLE, MERGE), DONE).astype(np.uint8)
    out = np.empty(len(order), np.uint8)
    out[order] = np.repeat(found, np.diff(np.append(begin, len(order))))
    return _split(out, keys, blocks)


def front_code(strings: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Prefix shared with the string before, the rests one after the other, and the lengths of the rests."""
    shared = np.zeros(len(strings), np.uint8)
    rests, before = [], b""
    for i, s in enumerate(strings):
        n = common(before, s, 0)
        shared[i] = n
        rests.append(s[n:])
        before = s
    return shared, b"".join(rests), np.array([len(r) for r in rests], np.uint8)


def front_decode(shared: np.ndarray, rests: bytes, lengths: np.ndarray) -> list[bytes]:
    out, at, before = [], 0, b""
    for n, length in zip(shared.tolist(), lengths.tolist()):
        before = before[:n] + rests[at : at + length]
        at += length
        out.append(before)
    return out


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    differ = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - (differ.bit_length() + 7) // 8


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merges sorted runs (strings, prefix shared with the one before): (run, place) in order, and the prefix that
    each string out shares with the one before it.

    A loser tree: an inner node keeps the loser of its match with the prefix it shares with the winner. Of two
    candidates the one that shares more with the last string out is smaller; only with equal prefixes are the
    bytes after them compared.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    shares = [list(r[1]) for r in runs] + [[]] * (k - len(runs))
    place = [0] * k
    # a candidate: (run, prefix shared with the last string out); prefix -1: the run has ended
    loser: list[tuple[int, int]] = [(0, -1)] * k

    def play(x: tuple[int, int], y: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        (a, la), (b, lb) = x, y
        if la != lb:
            return (x, y) if la > lb else (y, x)
        if la < 0:
            return x, y
        s, t = strings[a][place[a]], strings[b][place[b]]
        n = common(s, t, la)
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            return x, (b, n)
        return y, (a, n)

    def build(node: int) -> tuple[int, int]:
        if node >= k:
            r = node - k
            return (r, 0 if strings[r] else -1)
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    out, prefix = [], []
    winner = build(1) if k > 1 else (0, 0 if strings[0] else -1)
    while winner[1] >= 0:
        run = winner[0]
        out.append((run, place[run]))
        prefix.append(winner[1])
        place[run] += 1
        winner = (run, shares[run][place[run]] if place[run] < len(strings[run]) else -1)
        node = (run + k) // 2
        while node:
            winner, loser[node] = play(winner, loser[node])
            node //= 2
    return out, prefix


def _run_blocks(t: Anchored, some: np.ndarray, buckets: int) -> list[tuple]:
    """The contexts ``some`` as sorted runs of suffixes, by bucket of the seed; see ``_run_order``."""
    out = []
    for i, own, right, left in _runs_of(t, some, buckets):
        shared, rests, lengths = front_code(right)
        values = [
            ch.put(shared), ch.put(np.frombuffer(rests, np.uint8)), ch.put(lengths),
            ch.put(np.frombuffer(b"".join(left), np.uint8)), ch.put(np.array([len(x) for x in left], np.uint8)),
            ch.put((t.place[own] - t.high[own]).astype(np.uint8)), ch.put(t.id[own]), ch.put(t.at[own]),
        ]
        out.append((RUNS * buckets + i, b"", values))
    return out


def _run_order(t: Anchored, some: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    return [(i, own) for i, own, _, _ in _runs_of(t, some, buckets)]


def _runs_of(t: Anchored, some: np.ndarray, buckets: int):
    """By bucket: the contexts in order of suffix, the suffixes (anchor to the context's end), and the bytes before
    the anchors, reversed."""
    some = some[np.argsort(t.seed[some], kind="stable")]
    cuts = ch.bucket_cuts(t.seed[some], buckets)
    raw = t.data.tobytes()
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b == a:
            continue
        own = some[a:b]
        right = [raw[p : h + SPAN] for p, h in zip(t.place[own].tolist(), t.high[own].tolist())]
        order = sorted(range(len(own)), key=right.__getitem__)
        own = own[order]
        left = [raw[low:p][::-1] for low, p in zip(t.low[own].tolist(), t.place[own].tolist())]
        yield i, own, [right[j] for j in order], left


def _merged(blocks: list[dict]) -> list[tuple]:
    """Which windows of each context repeat an earlier one: a bit per offset of the anchor in the window."""
    runs, lefts, nearest, ids, ats = [], [], [], [], []
    for b in blocks:
        v = b["values"]
        shared, rests, lengths = ch.get(v[0], np.uint8), ch.get(v[1], np.uint8).tobytes(), ch.get(v[2], np.uint8)
        runs.append((front_decode(shared, rests, lengths), shared.tolist()))
        cuts = np.concatenate(([0], np.cumsum(ch.get(v[4], np.uint8), dtype=np.int64))).tolist()
        text = ch.get(v[3], np.uint8).tobytes()
        lefts.append([text[x:y] for x, y in zip(cuts, cuts[1:])])
        nearest.append(ch.get(v[5], np.uint8))
        ids.append(ch.get(v[6], np.int64))
        ats.append(ch.get(v[7], np.int64))
    order, prefix = merge(runs)
    n = len(order)
    begin = np.concatenate(([0], np.cumsum([len(r[0]) for r in runs])))
    entry = np.array([begin[r] + p for r, p in order], np.int64)
    # classes by the text after the anchor, for entries in merged order
    prefix = np.array(prefix, np.int64)
    left = [x for run in lefts for x in run]
    back = sorted(range(n), key=left.__getitem__)
    back_prefix = np.array([0] + [common(left[a], left[b], 0) for a, b in zip(back, back[1:])], np.int64)
    back = np.array(back, np.int64)
    farthest = np.array([len(x) for x in left], np.int64)
    near = np.concatenate(nearest).astype(np.int64)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.concatenate(ats), np.concatenate(ids)))] = np.arange(n)
    hit = np.zeros((n, OFFSETS), bool)
    after, before = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(OFFSETS):
        own = np.flatnonzero((near <= o) & (o <= farthest))
        if len(own) < 2:
            continue
        after[entry] = np.cumsum(prefix < SPAN - o)
        before[back] = np.cumsum(back_prefix < o)
        key = after[own] * (n + 1) + before[own]
        by = np.lexsort((rank[own], key))
        again = np.flatnonzero(key[by[1:]] == key[by[:-1]]) + 1
        hit[own[by[again]], o] = True
    bits = np.packbits(hit, axis=1)
    out, at = [], 0
    for block, (strings, _) in zip(blocks, runs):
        out.append((block["chunk"], ch.put(bits[at : at + len(strings)])))
        at += len(strings)
    return out


_ASK = "bucket int, keys binary, values array<binary>"


def _replies(table: pa.Table, kind: int, buckets: int, type_) -> np.ndarray:
    rows = sorted((r for r in table.select(["bucket", "reply"]).to_pylist() if r["bucket"] // buckets == kind), key=lambda r: r["bucket"])
    return np.concatenate([ch.get(r["reply"], type_) for r in rows]) if rows else np.zeros(0, type_)


class Verdict:
    """What the fingerprints' answers say of a chunk's anchors."""

    def __init__(self, t: Anchored, replies: pa.Table, buckets: int):
        some, first = _firsts(t.context, t.check)
        contexts, seeds = _replies(replies, CONTEXTS, buckets, np.uint8), _replies(replies, SEEDS, buckets, np.uint8)
        self.repeat = ~first
        self.repeat[some] = contexts == REPEAT
        names = np.unique(t.seed[some])
        state = seeds[np.searchsorted(names, t.seed[some])] if len(some) else seeds
        self.to_merge = np.sort(some[(contexts != REPEAT) & (state == MERGE)])
        self.single = np.sort(some[(contexts != REPEAT) & (state == SINGLE)])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes) of every row."""
    buckets = ch.chunk_count(docs)
    packed = ch.pack(docs, id_col, text_col, buckets)

    def fingerprints(blocks: list[dict]) -> list[tuple]:
        return _earliest(blocks, True) if blocks[0]["bucket"] // buckets == CONTEXTS else _several(blocks, hot)

    known = saved(ch.answer(ch.ask(packed, lambda texts: _ask_fingerprints(Anchored(texts), buckets), _ASK), fingerprints, "reply binary"))
    form = ch.kinds(f"chunk int, {_ASK}")

    def send_runs(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not replies.num_rows:
            return ch.table([], form)
        t = Anchored(texts)
        verdict = Verdict(t, replies, buckets)
        rows = _run_blocks(t, verdict.to_merge, buckets) if len(verdict.to_merge) else []
        if len(verdict.single):
            of, start, keys = t.window_keys(verdict.single)
            some, _ = _firsts(keys)
            rows += _blocks(WINDOWS, buckets, keys[some], t.id[of[some]], (t.at[of] + start - t.place[of])[some])
        chunk = ch.chunk_of(texts)
        return ch.table([(chunk, *r) for r in rows], form)

    def merged(blocks: list[dict]) -> list[tuple]:
        return _merged(blocks) if blocks[0]["bucket"] // buckets == RUNS else _earliest(blocks, False)

    def cut(texts: pa.Table, replies: pa.Table) -> pa.Table:
        t = Anchored(texts)
        change = np.zeros(len(t.data) + 1, np.int32)

        def cover(starts: np.ndarray, ends: np.ndarray) -> None:
            np.add.at(change, starts, 1)
            np.add.at(change, ends, -1)

        if len(t.place):
            verdict = Verdict(t, replies, buckets)
            cover(t.low[verdict.repeat], t.high[verdict.repeat] + SPAN)
            bits = _replies(replies, RUNS, buckets, np.uint8).reshape(-1, -(-OFFSETS // 8))
            if len(verdict.to_merge):
                own = np.concatenate([x for _, x in _run_order(t, verdict.to_merge, buckets)])
                row, offset = np.nonzero(np.unpackbits(bits, axis=1)[:, :OFFSETS])
                cover(t.place[own[row]] - offset, t.place[own[row]] - offset + SPAN)
            if len(verdict.single):
                _, start, keys = t.window_keys(verdict.single)
                some, first = _firsts(keys)
                again = ~first
                again[some] = _replies(replies, WINDOWS, buckets, np.uint8) == REPEAT
                cover(start[again], start[again] + SPAN)
        gone = np.cumsum(change[:-1]) > 0
        total = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
        before = np.zeros(len(gone), bool)
        before[1:] = gone[:-1]
        before[t.offsets[:-1][t.offsets[:-1] < len(gone)]] = False
        spans = np.concatenate(([0], np.cumsum(gone & ~before, dtype=np.int64)))
        size = np.diff(t.offsets)
        removed = np.diff(total[t.offsets])
        offsets = np.concatenate(([0], np.cumsum(size - removed)))
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(t.data[~gone].tobytes())])
        return pa.table(
            {
                "doc_id": texts["id"],
                "n_bytes": pa.array(size),
                "n_removed": pa.array(removed),
                "n_spans": pa.array(np.diff(spans[t.offsets])),
                "kept": kept.cast(pa.binary()),
            }
        )

    later = ch.answer(ch.meet(packed, known, send_runs, f"chunk int, {_ASK}"), merged, "reply binary")
    return ch.meet(packed, known.union(later), cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
