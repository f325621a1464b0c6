"""Secrets in texts: all rules in one deterministic automaton, one pass over the bytes of each text.

Every rule is a regular expression over ASCII bytes. Two automata come from all rules together, each by subset
construction and minimisation, as arrays of transitions by byte class:

* the backward one accepts, reading a text from its end, at each byte where a match of a rule begins; it is the one
  pass over the text, whatever the number of rules;
* the forward one runs from such a place only, as long as the rule can still match, and gives the longest end.

A rule's matches are taken from the left, none overlapping the one before; then those are dropped whose measured part
(the whole match, or one group) is shorter than ``least`` characters. A dropped match still covers its bytes.

The rules must agree with a backtracking matcher on the longest match at a place (greedy repeats, no alternative that is
a prefix of another); those below do. Patterns know literals, ``\\xNN`` and escaped signs, classes, groups, ``|`` and the
repeats ``? * + {n} {n,} {n,m}``.

Null and empty texts have no findings, an empty table gives an empty one, repeated rows are scanned one by one; only
the id and text columns are read, so other columns cannot clash. A text is scanned whole, whatever its length. Places
count code points; the automata are built once on the driver (their size depends on the rules alone) and sent to the workers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


@dataclass(frozen=True)
class SecretRule:
    """``least`` characters in ``group`` (0: the whole match), else a match is dropped."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False


# The three base kinds. Twenty-four or more hex digits are asked for in the pattern itself, which finds
# the same runs as dropping the shorter ones later.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 20),
    SecretRule("hex", r"[0-9a-f]{24,}", 24),
)
#: What the method adds: tokens that carry their issuer's prefix, signed web tokens, private key headers.
MORE_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    SecretRule("slack", r"xox[abposr]-[A-Za-z0-9-]+", 15),
    SecretRule("google", r"AIza[A-Za-z0-9_-]+", 39),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    SecretRule("private_key", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


# A pattern as a tree: ("set", bytes), ("seq", parts), ("alt", parts), ("rep", part, least, most or None).
def _parse(pattern: str, any_case: bool) -> tuple:
    at = 0

    def byte() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "\\":
            c = pattern[at]
            at += 1
            if c == "x":
                at += 2
                return int(pattern[at - 2 : at], 16)
            if c.isalnum():
                raise ValueError(f"\\{c} is not known in {pattern!r}")
        if ord(c) > 127:
            raise ValueError(f"{pattern!r} is not ASCII")
        return ord(c)

    def either(values: set[int]) -> tuple:
        if any_case:
            values = values | {ord(f) for v in values if chr(v).isalpha() for f in (chr(v).lower(), chr(v).upper())}
        return ("set", frozenset(values))

    def one() -> tuple:
        nonlocal at
        if pattern[at] == "(":
            at += 3 if pattern.startswith("(?:", at) else 1
            inner = choice()
            at += 1
            return inner
        if pattern[at] == "[":
            at += 1
            values: set[int] = set()
            while pattern[at] != "]":
                low = high = byte()
                if pattern[at] == "-" and pattern[at + 1] != "]":
                    at += 1
                    high = byte()
                values |= set(range(low, high + 1))
            at += 1
            return either(values)
        if pattern[at] in ".^$":
            raise ValueError(f"{pattern[at]} is not known in {pattern!r}")
        return either({byte()})

    def repeated() -> tuple:
        nonlocal at
        part = one()
        while at < len(pattern) and pattern[at] in "?*+{":
            if found := re.compile(r"\{(\d+)(,?)(\d*)\}").match(pattern, at):
                least = int(found[1])
                most = int(found[3]) if found[3] else None if found[2] else least
                at = found.end()
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                at += 1
            part = ("rep", part, least, most)
        return part

    def choice() -> tuple:
        nonlocal at
        parts, now = [], []
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                parts.append(("seq", now))
                now = []
            else:
                now.append(repeated())
        return ("alt", [*parts, ("seq", now)])

    return choice()


class _Places:
    """A nondeterministic automaton: per place its free moves and its moves by a set of bytes."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def new(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree: tuple, begin: int, backward: bool) -> int:
        """The place behind ``tree``, read from ``begin``."""
        kind = tree[0]
        if kind == "set":
            end = self.new()
            self.moves[begin].append((tree[1], end))
        elif kind == "seq":
            end = begin
            for part in reversed(tree[1]) if backward else tree[1]:
                end = self.add(part, end, backward)
        elif kind == "alt":
            end = self.new()
            for part in tree[1]:
                self.free[self.add(part, begin, backward)].append(end)
        else:
            _, part, least, most = tree
            end = begin
            for _ in range(least):
                end = self.add(part, end, backward)
            if most is None:
                loop = self.new()
                self.free[end].append(loop)
                self.free[self.add(part, loop, backward)].append(loop)
                end = loop
            else:
                out = self.new()
                for _ in range(most - least):
                    self.free[end].append(out)
                    inner = self.new()  # a place of its own, so that a loop in the part before is not entered again
                    self.free[end].append(inner)
                    end = self.add(part, inner, backward)
                self.free[end].append(out)
                end = out
        return end

    def closed(self, places) -> frozenset:
        seen, todo = set(places), list(places)
        while todo:
            for p in self.free[todo.pop()]:
                if p not in seen:
                    seen.add(p)
                    todo.append(p)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``next[state, byte class]``, ``accepts[state]`` and ``alive[state]`` (bits of rules that match, or still can); begins in state 0."""

    byte_class: np.ndarray
    next: np.ndarray
    accepts: np.ndarray
    alive: np.ndarray


def automaton(rules: tuple[SecretRule, ...], backward: bool) -> Automaton:
    """All rules in one: backward it may begin anywhere, forward at the first byte only."""
    nfa = _Places()
    first = nfa.new()
    ends: dict[int, int] = {}
    for i, rule in enumerate(rules):
        begin = nfa.new()
        nfa.free[first].append(begin)
        ends[nfa.add(_parse(rule.pattern, rule.any_case), begin, backward)] = 1 << i
    sets = {s for moves in nfa.moves for s, _ in moves}
    signs = [tuple(b in s for s in sets) for b in range(256)]
    classes = {sign: i for i, sign in enumerate(dict.fromkeys(signs))}
    byte_class = np.array([classes[s] for s in signs])
    sample = [int(np.flatnonzero(byte_class == c)[0]) for c in range(len(classes))]

    start = nfa.closed([first])
    numbers, todo, rows, accepts = {start: 0}, [start], [], []
    for state in todo:  # grows on the way
        row = []
        for b in sample:
            reached = {end for p in state for s, end in nfa.moves[p] if b in s}
            new = nfa.closed(reached) | start if backward else nfa.closed(reached)
            if new not in numbers:
                numbers[new] = len(todo)
                todo.append(new)
            row.append(numbers[new])
        rows.append(row)
        accepts.append(sum({ends[p] for p in state if p in ends}))
    return _minimised(byte_class, np.array(rows), np.array(accepts, np.int64))


def _minimised(byte_class: np.ndarray, moves: np.ndarray, accepts: np.ndarray) -> Automaton:
    """States that no text tells apart become one; the first state stays the first."""
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack((group, group[moves])), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    kept = np.unique(group, return_index=True)[1]
    order = np.argsort(kept)  # by the first state of each group: the group of state 0 comes first
    rank = np.empty(len(kept), np.int64)
    rank[order] = np.arange(len(kept))
    kept = kept[order]
    moves, accepts = rank[group[moves[kept]]], accepts[kept]
    alive = accepts.copy()
    while True:
        more = alive | np.bitwise_or.reduce(alive[moves], axis=1)
        if (more == alive).all():
            return Automaton(byte_class, moves, accepts, alive)
        alive = more


def _linked_rows(a: Automaton, ends: np.ndarray) -> list[list]:
    """A list per state: entry b is the list of the next state, entry 256 its number in ``ends``."""
    rows: list[list] = [[] for _ in a.next]
    for row, to, end in zip(rows, a.next[:, a.byte_class].tolist(), ends.tolist()):
        row.extend(rows[t] for t in to)
        row.append(end)
    return rows


class Scanner:
    """The automata of some rules, as a worker uses them."""

    def __init__(self, rules: tuple[SecretRule, ...], back: Automaton, ahead: Automaton):
        self.rules = rules
        self.exact = [re.compile(r.pattern.encode(), re.IGNORECASE if r.any_case else 0) for r in rules]
        self.masks, number = np.unique(np.append(0, back.accepts), return_inverse=True)
        self.back = _linked_rows(back, number.reshape(-1)[1:])[0]
        self.ahead = ahead.next[:, ahead.byte_class].tolist()
        self.accepts, self.alive = ahead.accepts.tolist(), ahead.alive.tolist()

    def starts(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places where a match of any rule begins, and the rules' bits; the one pass over all bytes."""
        marks = map(itemgetter(256), accumulate(data[::-1], getitem, initial=self.back))
        if len(self.masks) <= 256:
            seen = np.frombuffer(bytes(marks), np.uint8)[:0:-1]
        else:
            seen = np.fromiter(marks, np.int64, len(data) + 1)[:0:-1]
        at = np.flatnonzero(seen)
        return at, self.masks[seen[at]]

    def end(self, data: bytes, start: int, rule: int) -> int:
        state, best, bit = 0, start, 1 << rule
        for i in range(start, len(data)):
            state = self.ahead[state][data[i]]
            if self.accepts[state] & bit:
                best = i + 1
            if not self.alive[state] & bit:
                break
        return best

    def findings(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start, then rule."""
        at, masks = self.starts(data)
        out = []
        for r, rule in enumerate(self.rules):
            free = 0
            mine = at[masks >> r & 1 == 1]
            k = 0
            while k < len(mine):
                start = int(mine[k])
                free = self.end(data, start, r)
                size = free - start
                if rule.group:
                    size = len(self.exact[r].fullmatch(data, start, free)[rule.group])
                if size >= rule.least:
                    out.append((start, r, free))
                k = int(np.searchsorted(mine, free))
        return sorted(out)


def _points(data: bytes, places: list[int]) -> list[int]:
    """Code points before each byte place."""
    if data.isascii():
        return places
    lead = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
    return lead[places].tolist()


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``findings``: array of (kind, start, end, value), by start, then by the place of the rule among ``rules``."""
    if len(rules) > 62 or len({r.kind for r in rules}) < len(rules):
        raise ValueError("rules need kinds of their own, 62 at most")
    sent = docs.sparkSession.sparkContext.broadcast((rules, automaton(rules, True), automaton(rules, False)))
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
    of_id = docs.schema[id_col].dataType
    out = StructType([StructField("id", of_id), *StructType.fromDDL("findings array<struct<kind:string,start:long,end:long,value:string>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*sent.value)
        for batch in batches:
            found = []
            for text in batch.column(1).cast(pa.binary()):
                data = text.as_py() or b""
                now = scanner.findings(data)
                if now:
                    begins, ends = _points(data, [s for s, _, _ in now]), _points(data, [e for _, _, e in now])
                    now = [
                        {"kind": rules[r].kind, "start": b, "end": e, "value": data[s:t].decode()}
                        for (s, r, t), b, e in zip(now, begins, ends)
                    ]
                found.append(now)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], names=["id", "findings"])

    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, out)
    return df.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, text_col: str = "text", mark: str = "[{}]") -> DataFrame:
    """``docs`` with every finding replaced by its kind; where findings overlap, the earliest one counts (then the first rule)."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).alias("text"))
    found = scan(row, rules, "row")
    text = F.col("row").getField(text_col)

    def step(done, x):
        new = F.concat(done.text, F.substring(text, done.at + 1, x.start - done.at), F.format_string(mark.replace("{}", "%s"), x.kind))
        return F.when(x.start < done.at, done).otherwise(F.struct(new.alias("text"), x.end.cast("int").alias("at")))

    first = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    done = F.transform("findings", lambda x: F.struct(x.kind.alias("kind"), x.start.cast("int").alias("start"), x.end.cast("int").alias("end")))
    clean = F.aggregate(done, first, step, lambda x: F.concat(x.text, F.substring(text, x.at + 1, F.length(text))))
    fields = (clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns)
    return found.select(*fields)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of the numbered query: counts and hash of the base kinds, all findings as text."""

    def joined(findings):
        return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

    def of(*kinds):
        return F.filter("findings", lambda x: x.kind.isin(*kinds))

    base = tuple(r.kind for r in BASE_RULES)
    return found.select(
        id_col,
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(joined(of(*base)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )
