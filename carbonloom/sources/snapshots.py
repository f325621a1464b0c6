"""Fact tables in snapshots: readers see the table before a load or after it, never between.

A load writes the slices (partition values) that it replaces into a folder of its own, checks them there, and then
publishes a manifest: which load holds each slice now. Manifests are numbered, and creating the next number is the one step
that publishes; a load that was overtaken by another finds its number taken and fails (or goes on, where it is
repeatable). Files of a load that failed before are never listed, so never read. Old versions stay readable until
:func:`expire`.

    path/data/load=<id>/Date_Key=2024/Month=1/part-….parquet
    path/manifests/000000000007.json

A manifest lists slices (years, months), not files: some thousands at most. Spark lists the slices' files when it reads.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace as changed
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.constraints import Rule, enforce_unique, fail_on_broken
from .tables import _file_system, _read_text

_LOAD = "load"


class Overtaken(RuntimeError):
    """Another load published first."""


@dataclass(frozen=True)
class Snapshot:
    """``slices`` maps a slice such as ``Date_Key=2024/Month=1`` to the load that holds it; ``batches`` a stream to its last batch."""

    version: int
    schema: StructType
    partition_by: tuple[str, ...]
    slices: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    note: dict[str, object] = field(default_factory=dict)

    def to_json(self) -> str:
        own = {"version": self.version, "schema": self.schema.jsonValue(), "partition_by": self.partition_by}
        return json.dumps(own | {"slices": self.slices, "batches": self.batches, "note": self.note}, indent=1)

    @staticmethod
    def from_json(text: str) -> Snapshot:
        raw = json.loads(text)
        raw["schema"] = StructType.fromJson(raw["schema"])
        return Snapshot(**raw | {"partition_by": tuple(raw["partition_by"])})


@dataclass(frozen=True)
class Layout:
    """How rows lie inside a slice. ``cluster`` names integer columns with their bounds: rows are sorted along the curve that
    interleaves their bits, so that a filter on any of them meets few row groups. ``bloom`` columns get Bloom filters of
    ``bloom_values`` distinct values. ``row_group`` is in bytes."""

    cluster: tuple[tuple[str, int, int], ...] = ()
    bloom: tuple[str, ...] = ()
    bloom_values: int = 100_000
    row_group: int = 64 << 20


#: Cells of the curve that are dealt to partitions; rows of a cell are sorted together.
CELL_BITS = 6
#: Unpacked bytes of the rows that a task writes, about, and what a row takes beside its columns where it is sorted.
TASK_BYTES, ROW_BYTES = 128 << 20, 40
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread_bits(x: Column) -> Column:
    """A 31-bit number with a zero before each of its bits."""
    for by, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, by)).bitwiseAND(F.lit(mask))
    return x


def curve(parts: Sequence[tuple[str, int, int]]) -> Column:
    """Place on the curve of one or two integer columns with (low, high) bounds, each scaled to 16 bits; outside its bounds a
    value counts as the bound, NULL as the lower one."""

    def scaled(name: str, low: int, high: int) -> Column:
        inside = F.greatest(F.least(F.col(name).cast("long"), F.lit(high)), F.lit(low)) - F.lit(low)
        place = F.floor(inside * F.lit(65536) / F.lit(high - low + 1)).cast("long")
        return F.when(F.col(name).isNull(), F.lit(0).cast("long")).otherwise(place)

    if len(parts) == 1:
        return F.shiftleft(scaled(*parts[0]), 16)
    if len(parts) != 2:
        raise ValueError("one or two columns are interleaved")
    first, second = (scaled(*p) for p in parts)
    return F.shiftleft(_spread_bits(first), 1).bitwiseOR(_spread_bits(second))


def _folder(path: str) -> str:
    return f"{path}/manifests"


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _file_system(spark, _folder(path))
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _manifest(path: str, version: int) -> str:
    return f"{_folder(path)}/{version:012d}.json"


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest published state (or the one of ``version``); None before the first load."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    text = _read_text(spark, _manifest(path, version))
    if text is None:
        raise FileNotFoundError(f"{path} has no version {version}")
    return Snapshot.from_json(text)


def _publish(spark: SparkSession, path: str, new: Snapshot) -> None:
    """Writes the manifest aside and renames it to its number, which fails where the number is taken."""
    fs, folder = _file_system(spark, _folder(path))
    fs.mkdirs(folder)
    fs, aside = _file_system(spark, f"{_folder(path)}/{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(new.to_json(), "utf-8"))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    target = context.makeQualified(hadoop.Path(_manifest(path, new.version)))
    try:
        context.rename(context.makeQualified(aside), target, spark._sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as error:
        fs.delete(aside, False)
        if fs.exists(hadoop.Path(_manifest(path, new.version))):
            raise Overtaken(f"{path}: version {new.version} was published by another load") from error
        raise


def read_slices(spark: SparkSession, path: str, of: Snapshot, slices: Iterable[str] | None = None) -> DataFrame:
    """The rows of the snapshot, or of some of its slices; a filter on the partition columns prunes the others."""
    names = sorted(of.slices if slices is None else set(slices) & set(of.slices))
    if not names:
        return spark.createDataFrame([], of.schema)
    schema = StructType([*of.schema.fields, StructField(_LOAD, StringType())])
    folders = [f"{path}/data/{_LOAD}={of.slices[name]}/{name}" for name in names]
    found = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return found.select(*of.schema.names)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    of = snapshot(spark, path, version)
    if of is None:
        raise FileNotFoundError(f"{path} is not loaded yet")
    return read_slices(spark, path, of)


def _dealt(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows in tasks of some ``TASK_BYTES`` unpacked: small slices share one, a large one is split among several.

    A writing task sorts its rows by slice. Shuffled bytes say little of what it holds then: rows that are alike are packed to
    almost nothing, so that years of them would be dealt to one task. So slices are measured first, by their rows and the bytes
    of their strings. A row's task follows from its values and the task it comes from, and is the same if that is run again.
    """
    strings = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    row = sum(strings, F.lit(8 * len(df.columns) + ROW_BYTES).cast("long"))
    sizes = df.groupBy(*partition_by).agg(F.sum(row).alias("_bytes")).collect()
    if not sizes:
        return df
    placed, task, filled = [], 0, 0
    for *values, size in sorted(sizes, key=lambda r: [(v is not None, v) for v in r[:-1]]):
        if filled and filled + size > TASK_BYTES:
            task, filled = task + 1, 0
        parts = max(1, -(-size // TASK_BYTES))
        placed.append((*values, task, parts))
        task, filled = (task, filled + size) if parts == 1 else (task + parts, 0)
    names = [f"_slice{i}" for i in range(len(partition_by))]
    kinds = [StructField(n, df.schema[c].dataType) for n, c in zip(names, partition_by)]
    places = df.sparkSession.createDataFrame(placed, StructType([*kinds, StructField("_first", IntegerType()), StructField("_parts", IntegerType())]))
    same = reduce(and_, (df[c].eqNullSafe(places[n]) for n, c in zip(names, partition_by)))
    hashed = F.xxhash64(F.lit(0), *(df[c] for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct", "variant"))))
    # a row of a slice that was not there when they were measured still has a task
    first, parts = F.coalesce("_first", F.lit(0)), F.coalesce("_parts", F.lit(1))
    at = (first + F.pmod(hashed % parts + F.spark_partition_id(), parts)).cast("int")
    rows = df.join(F.broadcast(places), same, "left").select(*(df[c] for c in df.columns), at.alias("_task"))
    return rows.repartitionById(max(first + parts for *_, first, parts in placed), F.col("_task")).drop("_task")


def _write(df: DataFrame, path: str, partition_by: Sequence[str], layout: Layout) -> tuple[str, list[str]]:
    """Writes the rows as a new load, one folder per slice; its id and its slices."""
    spark, load = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/data/{_LOAD}={load}"
    if layout.cluster:
        # dealt by cells of the curve: Spark merges small ones and splits large ones, and nothing is sampled
        at = curve(layout.cluster)
        placed = df.withColumn("_at", at).withColumn("_cell", F.shiftright("_at", 32 - CELL_BITS))
        rows = placed.hint("rebalance", *partition_by, "_cell").sortWithinPartitions(*partition_by, "_at").drop("_at", "_cell")
    else:
        rows = _dealt(df, partition_by)
    writer = rows.write.partitionBy(*partition_by).option("parquet.block.size", layout.row_group)
    for column in layout.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True).option(f"parquet.bloom.filter.expected.ndv#{column}", layout.bloom_values)
    writer.parquet(folder)
    fs, pattern = _file_system(spark, "/".join([folder, *(f"{c}=*" for c in partition_by)]))
    found = [status.getPath() for status in fs.globStatus(pattern) or ()]
    depth = len(partition_by)
    return load, sorted("/".join(p.toUri().getPath().split("/")[-depth:]) for p in found)


def _slice_name(row, columns: Sequence[str]) -> str:
    return "/".join(f"{c}={row[c]}" for c in columns)


def staged_slices(staged: DataFrame, columns: Sequence[str]) -> list[str]:
    """The slices that a reload replaces; ``columns`` may be the first of the partition columns only (whole years)."""
    kept = staged.select(*columns)
    for c in columns:
        kept = kept.where(F.col(c).isNotNull())
    return sorted(_slice_name(r, columns) for r in kept.distinct().collect())


def _next(old: Snapshot | None, schema: StructType, partition_by: Sequence[str], **changes) -> Snapshot:
    if old is None:
        return Snapshot(1, schema, tuple(partition_by), **changes)
    return changed(old, version=old.version + 1, schema=schema, **changes)


def _ordered(df: DataFrame, partition_by: Sequence[str]) -> StructType:
    return StructType([*(f for f in df.schema.fields if f.name not in partition_by), *(df.schema[c] for c in partition_by)])


def replace(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    staged: Sequence[str],
    rules: Sequence[Rule] = (),
    key: str | None = None,
    layout: Layout = Layout(),
    note: dict[str, object] | None = None,
) -> Snapshot:
    """One load: all rows of the ``staged`` slices give way to ``df``, in one step.

    ``staged`` (:func:`staged_slices`) is taken before any lookup loses rows: a slice whose rows are all lost ends up
    empty. A broken rule fails the writing job; a doubled ``key`` is looked for in the files just written, key column
    only. Either leaves the table as it was.
    """
    spark = df.sparkSession
    old = snapshot(spark, path)
    if old is not None and old.partition_by != tuple(partition_by):
        raise ValueError(f"{path} is partitioned by {old.partition_by}")
    load, written = _write(fail_on_broken(df, path, list(rules)), path, partition_by, layout)
    new = _next(old, _ordered(df, partition_by), partition_by, note=note or {})
    fresh = {name: load for name in written}
    outside = [name for name in written if not any(name == s or name.startswith(f"{s}/") for s in staged)]
    if outside:
        raise ValueError(f"{path}: rows of slices that are not staged: {', '.join(outside[:3])}")
    if key is not None and fresh:
        enforce_unique(read_slices(spark, path, changed(new, slices=fresh)), path, [*partition_by, key])
    kept = {name: at for name, at in new.slices.items() if not any(name == s or name.startswith(f"{s}/") for s in staged)}
    new = changed(new, slices=kept | fresh)
    _publish(spark, path, new)
    return new


def upsert(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    key: str,
    newest: Column,
    rules: Sequence[Rule] = (),
    layout: Layout = Layout(),
    batch: tuple[str, int] | None = None,
    leave_out: Sequence[str] = (),
    tries: int = 5,
) -> Snapshot:
    """Rows of ``df`` replace those of the same ``key`` in their slices, which are written anew, and are added otherwise.

    Of rows with one key in ``df`` the one with the greatest ``newest`` counts. A key's rows must lie in one slice for good
    (the slice follows from the key). ``leave_out`` columns serve ``newest`` only. ``batch`` (stream, number) makes it repeatable: a batch that is
    published already changes nothing. Where another load publishes first, the merge is done again on its result.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in leave_out]
    latest = F.max_by(F.struct(*columns), newest).alias("_row")
    rows = df.groupBy(*partition_by, key).agg(latest).select("_row.*")
    rows = fail_on_broken(rows, path, list(rules)).persist()
    try:
        touched = [_slice_name(r, partition_by) for r in rows.select(*partition_by).distinct().collect()]
        for _ in range(tries):
            old = snapshot(spark, path)
            if batch is not None and old is not None and old.batches.get(batch[0], -1) >= batch[1]:
                return old
            merged = rows
            if old is not None and set(touched) & set(old.slices):
                before = read_slices(spark, path, old, touched)
                left = before.join(rows.select(*partition_by, key), [*partition_by, key], "left_anti")
                merged = left.select(*columns).unionByName(rows)
            fresh: dict[str, str] = {}
            if touched:
                load, written = _write(merged, path, partition_by, layout)
                fresh = {name: load for name in written}
            batches = dict(old.batches if old else {}) | ({batch[0]: batch[1]} if batch else {})
            slices = dict(old.slices if old else {}) | fresh
            new = _next(old, _ordered(rows, partition_by), partition_by, slices=slices, batches=batches, note={})
            try:
                _publish(spark, path, new)
                return new
            except Overtaken:
                continue
        raise Overtaken(f"{path}: overtaken {tries} times")
    finally:
        rows.unpersist()


def expire(spark: SparkSession, path: str, keep: int = 2, unlisted_after_s: float = 86_400) -> list[str]:
    """Forgets all but the last ``keep`` versions and deletes the slices that only older ones had; the loads that went whole.

    Loads that no version lists are of failed or running jobs: they go once they are ``unlisted_after_s`` old.
    """
    known = versions(spark, path)
    old = [snapshot(spark, path, v) for v in known[:-keep]]
    listed = {(load, name) for v in known[-keep:] for name, load in snapshot(spark, path, v).slices.items()}
    in_use, before = {load for load, _ in listed}, {load for s in old for load in s.slices.values()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, data = _file_system(spark, f"{path}/data")
    for version in old:
        for name, load in version.slices.items():
            if (load, name) not in listed:
                fs.delete(hadoop.Path(f"{path}/data/{_LOAD}={load}/{name}"), True)
        fs.delete(hadoop.Path(_manifest(path, version.version)), False)
    gone = []
    for status in fs.listStatus(data) if fs.exists(data) else ():
        load = status.getPath().getName().removeprefix(f"{_LOAD}=")
        aged = status.getModificationTime() / 1000 <= time.time() - unlisted_after_s
        if load not in in_use and (load in before or aged):
            fs.delete(status.getPath(), True)
            gone.append(load)
    return gone
