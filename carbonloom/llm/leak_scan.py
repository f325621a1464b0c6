"""Benchmark passages in documents: one Aho-Corasick automaton, one scan of each text.

Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. An item's windows are its runs of
``window`` consecutive words, or all its words where it has fewer. The automaton holds every window as
`` w1 w2 … `` and runs over the normalised text once; matches are mapped back to words and to character
offsets of the original text.

The benchmark is broadcast in slices of at most ``SLICE_BYTES`` of text, each an automaton of its own that
the texts of a batch pass in turn; the usual benchmark is one slice.

Null or empty texts have no words and no hits, items without words no windows; an empty benchmark gives no
hits. Repeated rows are scanned one by one. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Text of the benchmark that one automaton is built from at most.
SLICE_BYTES = 8 << 20

_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
#: Of this worker: a broadcast's id, its automaton and item ids.
_built: dict[int, tuple] = {}


def normalised_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def automaton(items: list[tuple[int, str | None]], window: int) -> ahocorasick.Automaton | None:
    """``items``: (place, text). A window's value is (number of words, places of the items that have it)."""
    found: dict[bytes, tuple[int, set[int]]] = {}
    for place, text in items:
        words = normalised_words(text)
        for i in range(max(len(words) - window + 1, min(len(words), 1))):
            part = words[i : i + window]
            found.setdefault(b" ".join(part), (len(part), set()))[1].add(place)
    if not found:
        return None
    out = ahocorasick.Automaton()
    for key, (n, places) in found.items():
        out.add_word(f" {key.decode('latin-1')} ", (n, tuple(places)))
    out.make_automaton()
    return out


def hits(words: list[bytes], one: ahocorasick.Automaton) -> tuple[np.ndarray, set[int]]:
    """Which words lie inside a window's occurrence, and the items of those windows."""
    text = f" {b' '.join(words).decode('latin-1')} "
    places: set[int] = set()
    ends, sizes = [], []
    for end, (n, of) in one.iter(text):
        ends.append(end)
        sizes.append(n)
        places.update(of)
    if not ends:
        return np.zeros(0, bool), places
    # the space at `end` closes word number (spaces before it)
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
    last = np.searchsorted(spaces, ends)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, last - np.array(sizes), 1)
    np.add.at(change, last, -1)
    return np.cumsum(change[:-1]) > 0, places


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def spans(text: str, hit: np.ndarray) -> list[dict]:
    """Character offsets of the maximal runs of hit words in the original text."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in _runs(hit)]


def _slices(spark, benchmark: DataFrame, item_col: str, text_col: str) -> list:
    """Broadcast lists of (item id, text), each within SLICE_BYTES; items are dealt by a hash of id and text."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = -(-total * 2 // SLICE_BYTES) if total > SLICE_BYTES // 2 else 1
    out = []
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        out.append(spark.sparkContext.broadcast([tuple(r) for r in part.collect()]))
    return out


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as strings, sorted, each once), spans (character offsets of hit runs)."""
    parts = [(b._jbroadcast.id(), b) for b in _slices(docs.sparkSession, benchmark, item_col, item_text_col)]
    out = StructType.fromDDL("id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")
    out = StructType([StructField("id", docs.schema[id_col].dataType), *out.fields[1:]])

    def build(key: int, part) -> tuple:
        if key not in _built:
            _built.clear()  # a worker holds one automaton at a time
            items = part.value
            _built[key] = (automaton(list(enumerate(t for _, t in items)), window), [i for i, _ in items])
        return _built[key]

    schema = pa.schema(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("items", pa.list_(pa.string())),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_words = [0] * len(texts)
            hit: list = [np.zeros(0, bool)] * len(texts)
            items: list[set] = [set() for _ in texts]
            for key, part in parts:
                one, names = build(key, part)
                for i, text in enumerate(texts):
                    words = normalised_words(text)
                    n_words[i] = len(words)
                    if one is None or not words:
                        continue
                    now, places = hits(words, one)
                    if places:
                        hit[i] = now if not len(hit[i]) else hit[i] | now
                        items[i].update(names[p] for p in places if names[p] is not None)
            columns = [
                pa.array(n_words, pa.int64()),
                pa.array([int(h.sum()) for h in hit], pa.int64()),
                pa.array([sorted(s) for s in items], schema.field("items").type),
                pa.array([spans(t, h) if len(h) else [] for t, h in zip(texts, hit)], schema.field("spans").type),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *schema.names])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, out)
    return found.withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, in whose text no window of the benchmark occurs."""
    numbered = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).alias("text"))
    found = scan(numbered, benchmark, window, "row")
    return found.where("n_hit = 0").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the numbered query."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
