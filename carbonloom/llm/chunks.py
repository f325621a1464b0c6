"""Texts in chunks, and questions about all chunks that come back to each.

Operators that need counts over the whole corpus for every position of every text (n-grams, anchors) work
in two passes. The texts are dealt into chunks by a hash of their id, and each chunk asks: it sends the
sorted distinct keys of its texts, in ranges of the key space (buckets), as packed blocks. Spark groups the
blocks by bucket, where the answer for each key is found with the keys of all other chunks, and groups the
answers by chunk, where the texts are met again. A key goes once per chunk, however often it occurs, so a
hot key costs one entry per chunk. Both passes read the same exchange of the texts.

There are as many chunks as shuffle partitions, or more if chunks would be larger than ``CHUNK_BYTES`` or
``GROWTH`` times the square root of the table's bytes: blocks are as many as chunks times buckets, so chunks grow with
the table (100 TB: 1 GB each).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carbonloom.llm import hashing as hs

CHUNK_BYTES, GROWTH = 8 << 20, 100
_CODEC = "zstd"


def chunk_count(docs: DataFrame) -> int:
    """From the planner's size estimate and the session's shuffle partitions; runs no job where the estimate can be one."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 54:  # 16 petabytes: a product of guesses, as behind a join; the strings are measured instead
        strings = [F.coalesce(F.sum(F.octet_length(f"`{c}`")), F.lit(0)) for c, kind in docs.dtypes if kind == "string"]
        size = sum(docs.agg(*strings).first()) if strings else 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-size // max(CHUNK_BYTES, GROWTH * math.isqrt(size))))


def chunk_of_id(id_col: str, chunks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(chunks)).cast("int")


def pack(docs: DataFrame, id_col: str, text_col: str, chunks: int, flag: Column | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """(chunk, part): the rows of each chunk as compressed Arrow blocks of id, text, ``flag`` (null is false) and the
    ``extra`` columns as e0, e1, …"""
    names = ["id", "text", "flag", *(f"e{i}" for i in range(len(extra)))]
    df = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.lit(False) if flag is None else flag, F.lit(False)).alias("flag"),
        *(F.col(f"`{c}`").alias(f"e{i}") for i, c in enumerate(extra)),
        chunk_of_id(id_col, chunks).alias("chunk"),
    )

    def blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
        options = pa.ipc.IpcWriteOptions(compression=_CODEC)
        chunk = np.asarray(batch.column("chunk"))
        order = np.argsort(chunk, kind="stable")
        table = pa.Table.from_batches([batch.select(names)]).take(pa.array(order))
        cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
        numbers, parts = [], []
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                writer.write_table(table.slice(a, b - a).combine_chunks())
            numbers.append(int(chunk[order[a]]))
            parts.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield blocks(batch)
                hs.give_back()

    return df.mapInArrow(run, "chunk int, part binary")


def unpack(parts: pa.ChunkedArray) -> pa.Table:
    """(id, text, flag, e0, …) of a chunk, in order of id (null first), then text: the same order whatever order the blocks came in."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for c in parts.chunks for p in c]
    table = pa.concat_tables(tables)
    ids = table["id"].combine_chunks()
    if ids.null_count or len(set(ids.to_pylist())) < len(ids):
        keys = [("id", "ascending"), ("text", "ascending")]
        return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start")).combine_chunks()
    return table.take(pc.sort_indices(ids)).combine_chunks()


def ask(packed: DataFrame, question: Callable[[pa.Table], list[tuple]], columns: str) -> DataFrame:
    """Rows (chunk, then ``columns``) of ``question(texts)`` for every chunk."""
    schema = f"chunk int, {columns}"

    def run(blocks: pa.Table) -> pa.Table:
        chunk = blocks["chunk"][0].as_py()
        rows = question(_numbered(unpack(blocks["part"]), chunk))
        hs.give_back()
        return table([(chunk, *row) for row in rows], form)

    form = kinds(schema)
    return packed.groupBy("chunk").applyInArrow(run, schema)


def answer(asked: DataFrame, reply: Callable[[list[dict]], list[tuple]], columns: str) -> DataFrame:
    """Rows (chunk, bucket, then ``columns``) of ``reply(blocks of a bucket, in order of chunk)``."""
    schema = f"chunk int, bucket int, {columns}"
    form = kinds(schema)

    def run(blocks: pa.Table) -> pa.Table:
        rows = sorted(blocks.to_pylist(), key=lambda r: r["chunk"])
        bucket = rows[0]["bucket"]
        found = reply(rows)
        hs.give_back()
        return table([(chunk, bucket, *rest) for chunk, *rest in found], form)

    return asked.groupBy("bucket").applyInArrow(run, schema)


def meet(packed: DataFrame, answers: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``use(texts, answers of the chunk)`` for every chunk of texts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table([], form)
        found = use(_numbered(unpack(left["part"]), left["chunk"][0].as_py()), right)
        hs.give_back()
        return found

    form = kinds(schema)
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def _numbered(texts: pa.Table, chunk: int) -> pa.Table:
    return texts.replace_schema_metadata({"chunk": str(chunk)})


def chunk_of(texts: pa.Table) -> int:
    """The number of the chunk that ``ask`` or ``meet`` gave."""
    return int(texts.schema.metadata[b"chunk"])


def kinds(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Sorted keys cut into ``buckets`` equal ranges of the 64-bit space: where each begins, and the end."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)])).astype(np.int64)


def put_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences of the fewest bytes that hold them all; their high bytes, mostly alike, stand together."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, math.ceil(int(steps[1:].max()).bit_length() / 8)) if len(keys) > 1 else 1
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)
    return bytes([width]) + raw[0].tobytes() + put(raw[1:, :width].T)


def get_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    rest = get(data[9:], np.uint8).reshape(width, -1)
    raw = np.zeros((rest.shape[1] + 1, 8), np.uint8)
    raw[0] = np.frombuffer(data, np.uint8, 8, 1)
    raw[1:, :width] = rest.T
    return np.cumsum(raw.reshape(-1).view("<u8"), dtype=np.uint64)


def put(values: np.ndarray) -> bytes:
    """An array, compressed; its type is not stored."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec=_CODEC, asbytes=True) if raw else b"")


def get(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=size, codec=_CODEC, asbytes=True) if size else b""
    return np.frombuffer(raw, kind)


def put_planes(values: np.ndarray) -> bytes:
    """As :func:`put`, with first bytes, second bytes, … together: for numbers whose high bytes are mostly alike."""
    return put(values.view(np.uint8).reshape(len(values), -1).T) if len(values) else put(values)


def get_planes(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(get(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
