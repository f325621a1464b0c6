"""URL rules as one bit-parallel wildcard automaton.

All glob rules are packed side by side into multiword Shift-And masks and run over each canonical URL
(host and path) at once: one bit per pattern byte, one step per URL byte, 64 pattern bytes per word. The
URLs of a batch advance together, so a step is a few array operations over (URLs x words).

Globs: ``?`` is one character but ``/``, ``*`` any run without ``/``, ``**`` any run; all else is itself.
A pattern must match the whole canonical URL.

A null URL or one without ``://`` has an empty host and path and is matched like any other text. Empty
tables, repeated rows and very long URLs need no special case; columns beside id and URL are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ANY = frozenset(range(256))
_NO_SLASH = _ANY - {0x2F}


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased) and path (up to ``?`` or ``#``)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


@dataclass(frozen=True)
class UrlRule:
    """``name`` has host, then a path that starts with ``/``; it fits the host, its subdomains and longer paths."""

    verdict: str
    name: str

    def globs(self) -> tuple[str, str]:
        escaped = "".join(f"\\{c}" if c in "*?\\" else c for c in self.name)
        return f"{escaped}**", f"*.{escaped}**"


def _parse(glob: str) -> tuple[list[frozenset], list[frozenset | None]]:
    """Byte classes of the pattern's places, and for every state (0 = nothing read) the bytes it stays on."""
    places: list[frozenset] = []
    stays: list[frozenset | None] = [None]
    i = 0
    while i < len(glob):
        c = glob[i]
        if glob.startswith("**", i):
            stays[-1] = _ANY
            i += 2
        elif c == "*":
            stays[-1] = stays[-1] or _NO_SLASH
            i += 1
        else:
            if c == "\\" and i + 1 < len(glob):
                i += 1
                c = glob[i]
                classes = [frozenset([b]) for b in c.encode()]
            elif c == "?":
                classes = [_NO_SLASH]
            else:
                classes = [frozenset([b]) for b in c.encode()]
            for one in classes:
                places.append(one)
                stays.append(None)
            i += 1
    return places, stays


class Automaton:
    """Masks of all patterns. State j of a pattern (j bytes of it read) is a bit; state 0 opens the pattern."""

    def __init__(self, globs: Sequence[str]):
        parsed = [_parse(g) for g in globs]
        bits = sum(len(stays) for _, stays in parsed)
        self.words = max(1, -(-bits // 64))
        # step[b]: states that byte b leads into; stay[b]: states that byte b leaves as they are
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        at = 0
        for places, stays in parsed:
            self._set(self.start, at)
            for j, one in enumerate(places):
                for b in one:
                    self._set(self.step[b], at + j + 1)
            for j, one in enumerate(stays):
                for b in one or ():
                    self._set(self.stay[b], at + j)
            last = at + len(places)
            self.final.append((last // 64, np.uint64(1 << (last % 64))))
            at += len(stays)

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << (bit % 64))

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts x patterns) booleans; text i is ``data[offsets[i]:offsets[i + 1]]``.

        The texts advance in order of length, longest first, so that those which have ended are cut off
        the end of the state table instead of being masked.
        """
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        length, begin = length[order], offsets[:-1][order]
        state = np.broadcast_to(self.start, (len(order), self.words)).copy()
        one, top = np.uint64(1), np.uint64(63)
        live = len(order)
        for k in range(int(length[0]) if live else 0):
            live = int(np.searchsorted(-length[:live], -k, side="left"))  # those longer than k
            byte = data[begin[:live] + k]
            now = state[:live]
            moved = now << one
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.zeros((len(order), len(self.final)), bool)
        for p, (word, bit) in enumerate(self.final):
            out[order, p] = (state[:, word] & bit) != 0
        return out


def judge(
    pages: DataFrame, rules: Sequence[UrlRule], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: id, host, path, the longest rule that fits (else null) and its verdict (else ``default``).

    Rules of equal length cannot both fit one URL unless they are the same text; the first stands then.
    """
    rules = sorted(rules, key=lambda r: -len(r.name.encode()))
    names = pa.array([r.name for r in rules] or [""])
    automaton = Automaton([g for r in rules for g in r.globs()])
    n_rules = len(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.binary_join_element_wise(batch.column("host"), batch.column("path"), "")
            text = text.cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            hits = automaton.matches(data, offsets).reshape(len(text), n_rules, 2).any(axis=2)
            first = np.where(hits.any(axis=1), hits.argmax(axis=1), -1) if n_rules else np.full(len(text), -1)
            rule = names.take(pa.array(first, mask=first < 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("host"), batch.column("path"), rule], names=["id", "host", "path", "rule"])

    host, path = canonical(F.col(url_col))
    ids = pages.schema[id_col].dataType.simpleString()
    found = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).mapInArrow(
        run, f"id {ids}, host string, path string, rule string"
    )
    verdict = F.lit(default)
    for r in reversed(rules):
        verdict = F.when(F.col("rule") == r.name, F.lit(r.verdict)).otherwise(verdict)
    return found.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
