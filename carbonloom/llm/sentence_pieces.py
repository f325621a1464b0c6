"""SentencePiece unigram encoding and decoding: Viterbi over a double-array trie of pieces.

The vocabulary (pieces, scores, byte pieces) is read from a model file whose path is a parameter. Unigram models
hold log probabilities; merge models hold ranks, which are read as Zipf's law: log p = -ln(1 + rank) - ln(sum).

A text gets one space in front and is cut before each space that follows another byte; no piece reaches
over such a cut (checked when the vocabulary is read; else texts are not cut), so each distinct stretch is
encoded once per worker and batch. All stretches of a block advance together: one step per byte, array operations
over the stretches. The whitespace marker is a space in the trie, so a text's own U+2581 is never taken for one;
it goes to byte pieces, as all characters without a piece do, at the least score minus 10. Of equal paths the
one that ends in the longer piece stands.

Decoding joins the pieces' bytes and drops the first space; control pieces are nothing, ids outside the vocabulary and
the unknown piece U+2047. ``decode(encode(text))`` is the text itself, byte for byte.

A null text has null ids, an empty one none; null ids decode to null. Rows are encoded one by one; texts of any
length are encoded whole. Columns beside id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carbonloom.llm import chunks as ch

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Scores that differ by less are equal.
TIE = 1e-9
#: Stretches longer than this are encoded alone, others in blocks of about so many cells.
LONG, CELLS = 512, 1 << 19
#: Stretches whose pieces a worker keeps.
SEEN = 150_000
#: Bytes that are encoded, and ids that are decoded together, about.
ENCODED = 1 << 20
DECODED = 400_000
_CUT = re.compile(rb" +[^ ]*")


class DoubleArray:
    """State t is the child of s by byte b if t = base[s] + b + 1 and check[t] = s; value[t] is the piece that ends there."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, piece in keys:
            node = 0
            for b in key:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][b]
            value[node] = piece
        size = 2 * len(children) + 8192
        base, check, last = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        lowest, several, todo = 1, 1, [(0, 0)]
        for node, state in todo:
            last[state] = value[node]
            below = sorted(children[node])
            if not below:
                continue
            if len(below) == 1:
                while not free[lowest] or lowest <= below[0]:
                    lowest += 1
                at = lowest - below[0] - 1
                lowest = 1 if lowest <= 256 else lowest  # the first slots suit small bytes only
            else:
                while True:
                    window = several + np.arange(4096)
                    if window[-1] + 258 >= len(free):
                        free = np.concatenate((free, np.ones(size, bool)))
                        base, check, last = (np.concatenate((x, np.full(size, y, np.int32))) for x, y in ((base, 0), (check, -1), (last, -1)))
                    fits = free[window + below[0] + 1]
                    for b in below[1:]:
                        fits = fits & free[window + b + 1]
                    if fits.any():
                        at = several + int(fits.argmax())
                        break
                    several += 4096
            base[state] = at
            for b in below:
                free[at + b + 1] = False
                check[at + b + 1] = state
                todo.append((children[node][b], at + b + 1))
        # a state plus any byte stays inside the arrays
        end = int(base.max()) + 258
        pad = max(0, end - len(base))
        self.base, self.check, self.value = (
            np.concatenate((x, np.full(pad, y, np.int32)))[:end] for x, y in ((base, 0), (check, -1), (last, -1))
        )


@dataclass
class Vocabulary:
    pieces: list[bytes]
    """What each piece decodes to; the marker is a space."""
    scores: np.ndarray
    trie: DoubleArray
    byte_ids: np.ndarray
    unknown: float
    cuts: bool


def vocabulary(pieces: list[tuple[str, float, str]]) -> Vocabulary:
    """``pieces``: text, score and kind (normal, byte, control or unknown), in order of id."""
    ranks = all(s <= 0 and float(s).is_integer() for _, s, kind in pieces if kind == "normal")
    scores = np.array([s if kind == "normal" else 0.0 for _, s, kind in pieces])
    normal = np.array([kind == "normal" for _, _, kind in pieces], bool)
    if ranks and normal.any():
        scores[normal] = -np.log1p(-scores[normal])
        scores[normal] -= np.log(np.exp(scores[normal]).sum())
    byte_ids = np.full(256, -1, np.int32)
    raw, keys = [], []
    for i, (text, _, kind) in enumerate(pieces):
        if kind == "byte":
            byte_ids[int(text[1:-1], 16)] = i
            raw.append(bytes([int(text[1:-1], 16)]))
        elif kind == "normal":
            raw.append(text.replace(MARKER, " ").encode())
            keys.append((raw[-1], i))
        else:
            raw.append(b"" if kind == "control" else "⁇".encode())
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    unknown = (scores[normal].min() if normal.any() else 0.0) - UNKNOWN_PENALTY
    return Vocabulary(raw, scores, DoubleArray(keys), byte_ids, float(unknown), all(b" " not in k.lstrip(b" ") for k, _ in keys))


def read_vocabulary(path: str) -> Vocabulary:
    """From a SentencePiece model file, read where this is called."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        return "byte" if model.is_byte(i) else "control" if model.is_control(i) else "unknown" if model.is_unknown(i) else "normal"

    return vocabulary([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())])


_WIDTH = np.ones(256, np.int64)
_WIDTH[0xC0:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:] = 2, 3, 4


def _block(v: Vocabulary, stretches: list[bytes], length: np.ndarray) -> list[np.ndarray]:
    """Ids of stretches of similar length, all advancing together."""
    n, width = len(stretches), int(length.max())
    data = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in stretches]), np.uint8).reshape(n, width)
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    back, piece = np.zeros((n, width + 1), np.int16), np.zeros((n, width + 1), np.int32)
    base, check, value = v.trie.base, v.trie.check, v.trie.value
    for s in range(width):
        lane = np.flatnonzero((length > s) & (best[:, s] > -np.inf))
        if not len(lane):
            continue
        start = best[lane, s]
        char = _WIDTH[data[lane, s]]
        single = np.zeros(len(lane), bool)
        live, state = np.arange(len(lane)), np.zeros(len(lane), np.int32)
        for at in range(s, width):
            row = lane[live]
            child = base[state] + data[row, at] + 1
            step = (check[child] == state) & (length[row] > at)
            live, state = live[step], child[step]
            if not len(live):
                break
            found = value[state]
            has = found >= 0
            some, ids = live[has], found[has]
            single[some[char[some] == at + 1 - s]] = True
            total = start[some] + v.scores[ids]
            row = lane[some]
            better = total > best[row, at + 1] + TIE
            row = row[better]
            best[row, at + 1], back[row, at + 1], piece[row, at + 1] = total[better], at + 1 - s, ids[better]
        # a character without a piece of its own: byte by byte
        alone = np.flatnonzero(~single)
        for k in range(1, 5):
            some = alone[char[alone] >= k]
            if not len(some):
                break
            row = lane[some]
            last = char[some] == k
            total = start[some] + v.unknown
            take = ~last | (total > best[row, s + k] + TIE)
            row = row[take]
            back[row, s + k], piece[row, s + k] = 1, v.byte_ids[data[row, s + k - 1]]
            best[row[last[take]], s + k] = total[take][last[take]]
    at, ids, sizes = length.copy(), [], np.zeros(n, np.int64)
    while True:
        row = np.flatnonzero(at > 0)
        if not len(row):
            break
        column = np.full(n, -1, np.int32)
        column[row] = piece[row, at[row]]
        sizes[row] += 1
        ids.append(column)
        at[row] -= back[row, at[row]]
    table = np.stack(ids, 1) if ids else np.zeros((n, 0), np.int32)
    return [table[i, :k][::-1] for i, k in enumerate(sizes.tolist())]


def _alone(v: Vocabulary, stretch: bytes) -> np.ndarray:
    """Ids of one long stretch, byte by byte."""
    base, check, value, scores = v.trie.base, v.trie.check, v.trie.value, v.scores
    n = len(stretch)
    best, back, piece = [-np.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    best[0] = 0.0
    for s in range(n):
        if best[s] == -np.inf:
            continue
        char, single, state = int(_WIDTH[stretch[s]]), False, 0
        for at in range(s, n):
            child = int(base[state]) + stretch[at] + 1
            if check[child] != state:
                break
            state = child
            if value[state] >= 0:
                single |= at + 1 - s == char
                total = best[s] + float(scores[value[state]])
                if total > best[at + 1] + TIE:
                    best[at + 1], back[at + 1], piece[at + 1] = total, at + 1 - s, int(value[state])
        if not single:
            for k in range(1, char + 1):
                if k < char or best[s] + v.unknown > best[s + k] + TIE:
                    back[s + k], piece[s + k] = 1, int(v.byte_ids[stretch[s + k - 1]])
                    if k == char:
                        best[s + k] = best[s] + v.unknown
    out = []
    while n:
        out.append(piece[n])
        n -= back[n]
    return np.array(out[::-1], np.int32)


def encode_stretches(v: Vocabulary, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all stretches one after the other, and how many each has."""
    length = np.fromiter(map(len, stretches), np.int64, len(stretches))
    order = np.argsort(length, kind="stable")
    ranked = length[order]
    found: list[np.ndarray] = []
    a = 0
    while a < len(order):
        size = int(ranked[a])
        if size > LONG:
            found.append(_alone(v, stretches[order[a]]))
            a += 1
            continue
        most = a + max(16, CELLS // max(size, 1))
        b = min(most, int(np.searchsorted(ranked, min(size + 4 + size // 4, LONG), side="right")))
        found.extend(_block(v, [stretches[i] for i in order[a:b].tolist()], ranked[a:b]))
        a = b
    sizes = np.empty(len(order), np.int64)
    sizes[order] = [len(x) for x in found]
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    flat = np.empty(int(sizes.sum()), np.int32)
    if len(flat):
        flat[_spread(begin[order], sizes[order])] = np.concatenate(found)
    return flat, sizes


def _spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, … (sizes[0] places), begin[1], …"""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - sizes), sizes)


class Encoder:
    """Keeps the ids of the stretches it has met: ``flat[begin[i] : begin[i] + size[i]]`` for stretch number i."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        stretches: list[bytes] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                raw = b" " + text.encode("utf-8", "surrogatepass")
                stretches += _CUT.findall(raw) if self.v.cuts else [raw]
            ends[i + 1] = len(stretches)
        if len(self.place) > SEEN:
            self.clear()
        new = list(set(stretches).difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.begin), len(self.begin) + len(new))))
            flat, size = encode_stretches(self.v, new)
            self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(size) - size))
            self.flat, self.size = np.concatenate((self.flat, flat)), np.concatenate((self.size, size))
        place = np.fromiter(map(self.place.__getitem__, stretches), np.int64, len(stretches))
        sizes = self.size[place]
        offsets = np.concatenate(([0], np.cumsum(sizes)))[ends]
        values = self.flat[_spread(self.begin[place], sizes)]
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), mask=pa.array([t is None for t in texts], pa.bool_())
        )


class Decoder:
    def __init__(self, v: Vocabulary):
        raw = [*v.pieces, "\u2047".encode()]
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """Texts of lists of ids; null lists give null."""
        none = lists.is_null().to_numpy(zero_copy_only=False)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.fill_null(-1).to_numpy()[bounds[0] : bounds[-1]].astype(np.int64)
        ids[(ids < 0) | (ids >= len(self.sizes) - 1)] = len(self.sizes) - 1
        sizes = self.sizes[ids]
        data = self.bytes[_spread(self.begin[ids], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[bounds - bounds[0]]
        first = ends[:-1][ends[:-1] < ends[1:]]
        keep = np.ones(len(data), bool)
        keep[first[data[first] == 0x20]] = False
        offsets = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[ends]
        raw = data[keep].tobytes()
        cuts = offsets.tolist()
        texts = [None if gone else raw[a:b].decode("utf-8", "replace") for gone, a, b in zip(none, cuts, cuts[1:])]
        return pa.array(texts, pa.string())


def decode_ids(v: Vocabulary, ids: list[int] | None) -> str | None:
    return Decoder(v).decode(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


#: Of this worker: a broadcast's id, its encoder and decoder.
_workers: dict[int, tuple[Encoder, Decoder]] = {}


def _shared(docs: DataFrame, v: Vocabulary):
    broadcast = docs.sparkSession.sparkContext.broadcast(v)
    key = broadcast._jbroadcast.id()

    def get() -> tuple[Encoder, Decoder]:
        if key not in _workers:
            _workers.clear()
            _workers[key] = Encoder(broadcast.value), Decoder(broadcast.value)
        return _workers[key]

    return get


def encode(
    docs: DataFrame, v: Vocabulary, id_col: str = "doc_id", text_col: str = "text", decoded: str | None = None
) -> DataFrame:
    """The id and text columns, and ``ids``; with ``decoded``, a column of that name with the ids decoded again, in the
    same pass. The vocabulary (about a megabyte) is broadcast."""
    get = _shared(docs, v)
    kinds = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a batch of long texts is encoded in parts, so that the lists of stretches stay small
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy()
            part = np.cumsum(sizes, dtype=np.int64) // ENCODED
            for a, b in zip(starts := ch.runs(part).tolist(), [*starts[1:], len(sizes)]):
                ids = get()[0].encode(batch.column(1).slice(a, b - a).to_pylist())
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), ids]
                if decoded:
                    columns.append(get()[1].decode(ids))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text", "ids", "decoded"][: len(columns)])

    schema = f"id {kinds.schema['id'].dataType.simpleString()}, text string, ids array<int>"
    out = kinds.mapInArrow(run, schema + (", decoded string" if decoded else ""))
    return out.select(
        F.col("id").alias(id_col), F.col("text").alias(text_col), "ids", *([F.col("decoded").alias(decoded)] if decoded else [])
    )


def decode(encoded: DataFrame, v: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the decoded text."""
    get = _shared(encoded, v)
    names = [f"c{i}" for i in range(len(encoded.columns))]
    at = encoded.columns.index(ids_col)
    plain = encoded.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # in parts: the places of all bytes of a batch would be large
            sizes = batch.column(at).value_lengths().fill_null(0).to_numpy()
            part = np.cumsum(sizes) // DECODED
            for a, b in zip(starts := ch.runs(part).tolist(), [*starts[1:], len(sizes)]):
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns, get()[1].decode(rows.column(at))], names=[*names, "text"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    return plain.mapInArrow(run, f"{schema}, text string").toDF(*encoded.columns, out)
