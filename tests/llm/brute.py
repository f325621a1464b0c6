"""Plain restatements of the contracts, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import os
import re

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = r"[^\x20\x09-\x0D]+"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(text):
    return (text or "").translate(UP)


class Union:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def shingles(text, n=5):
    words = re.findall(WORD, fold(text))
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1)))}


def linked(sets, percent=75):
    """Component by id over all pairs of sets; an empty set links with nothing."""
    union = Union(sets)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                union.join(a, b)
    return {x: union.root(x) for x in ids}


def without_repeats(texts, span=100):
    """{id: (bytes, removed, spans, rest)}"""
    seen, out = set(), {}
    for key in sorted(texts):
        raw = (texts[key] or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - span + 1):
            part = raw[i : i + span]
            if part in seen:
                gone[i : i + span] = [True] * span
            seen.add(part)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


BLANKS = " \t\x0b\f\r"


def lines(text):
    return [(i, x.strip(BLANKS).encode()) for i, x in enumerate((text or "").split("\n")) if x.strip(BLANKS)]


def line_shingles(line, n=5):
    """Shingles of characters."""
    line = line.decode("utf-8", "surrogatepass")
    return {line[i : i + n] for i in range(max(len(line) - n + 1, 1))}


def deduplicated(texts, percent=75):
    """{id: text} with one line, the earliest, of each component of similar lines."""
    first = {}
    for key in sorted(texts):
        for i, line in lines(texts[key]):
            first.setdefault(line, (key, i))
    by_place = {place: line for line, place in first.items()}
    comps = linked({place: line_shingles(line) for place, line in by_place.items()}, percent)
    out = {}
    for key, text in texts.items():
        if text is None:
            out[key] = None
            continue
        gone = {i for i, line in lines(text) if comps[first[line]] != (key, i)}
        out[key] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def leak_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def leaks(texts, items, window=10):
    """{id: (words, hit, items)}"""
    windows = collections.defaultdict(set)
    for item, text in items:
        words = leak_words(text)
        for i in range(max(len(words) - window + 1, min(len(words), 1))):
            windows[tuple(words[i : i + window])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for key, text in texts.items():
        words, hit, found = leak_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                of = windows.get(tuple(words[i : i + n]))
                if of:
                    hit.update(range(i, i + n))
                    found |= of
        out[key] = (len(words), len(hit), sorted(found))
    return out


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
