"""Words, lines and n-grams of many texts at once: byte arrays in, 64-bit hashes out.

Hashes are sums of byte values times powers of an odd number (modulo 2^64), so that the hash of any stretch
is a difference of running sums; a finaliser spreads them over all bits.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

# Arrow's own pools keep memory that is freed; the workers of an executor share its limit.
pa.set_memory_pool(pa.system_memory_pool())
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Freed memory back to the system, where the C library can: a worker that has done a chunk else keeps the most it ever took."""
    if _trim is not None:
        _trim(0)


_RATIO = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RATIO, -1, 1 << 64)
#: Bytes of text that are worked on together, so that the arrays of a step stay small.
PIECE = 512 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def _values(fold: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if fold:
        table[0x41:0x5B] = table[0x61:0x7B]
    return table


_EXACT, _FOLDED = _values(False), _values(True)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 1024), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps)
    return have[:n]


class Running:
    """Running sums over a byte array; ``of(starts, ends)`` hashes its stretches, equal bytes to equal hashes."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        table = _FOLDED if fold else _EXACT
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * _power("up", _RATIO, len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        down = _power("down", _INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins and ends; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> list[tuple[int, int]]:
    """Runs of whole texts, of about ``size`` bytes each or one longer text."""
    out, a, n = [], 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        out.append((a, min(b, n)))
        a = out[-1][1]
    return out


#: Bytes of words as the contracts state them: all but space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def stretches(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross texts: starts, ends, and per text the first run's number."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[(last >= 0) & (last < n)]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(texts: pa.Array | pa.ChunkedArray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, in order, and per text where its words begin (one more at the end)."""
    data, offsets = buffers(texts)
    hashes, firsts, total = [], [np.zeros(1, np.int64)], 0
    for a, b in pieces(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = stretches(WORD_BYTES[part], own)
        hashes.append(Running(part, fold).of(starts, ends))
        firsts.append(first[1:] + total)
        total += len(starts)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


_STEPS = mix(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def grams(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n consecutive words of a text; of all its words where it has fewer. Also the text's number."""
    counts = np.diff(firsts)
    total = np.zeros(len(hashes), np.uint64)
    for j in range(min(n, len(hashes))):
        total[: len(hashes) - j] += hashes[j:] * _STEPS[j]
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(len(hashes)) + n <= firsts[owner + 1]
    out, of = mix(total[whole] + np.uint64(n)), owner[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = []
        for t in short:
            own = hashes[firsts[t] : firsts[t + 1]]
            extra.append((own * _STEPS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own)))
        out, of = np.concatenate((out, mix(np.array(extra, np.uint64)))), np.concatenate((of, short))
    return out, of
