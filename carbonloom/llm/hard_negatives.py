"""Hard negatives from vectors: blocks in Hilbert order, bounds from zone maps choose which blocks an anchor reads.

Vectors become integers, floor(scale * x). The rows are sorted along a Hilbert curve through all dimensions (range partitions,
split anywhere, also inside a run of equal vectors), cut into blocks of ``BLOCK`` rows and written as Parquet, a block a
row, with its zone map: the least and the largest value of each dimension and the labels inside. Interval arithmetic
on a zone map bounds all scores of an anchor with the block's rows from both sides, exactly, as all is integer.

Two rounds read the table, each with slots that take the best k rows between a floor and a cap:

* positives: one slot per anchor, rows of its label, floor at the k-th best of its own part of the curve;
* negatives: one slot per positive, rows of other labels with low * p <= 100 * score <= high * p, floor at the k-th best of the
  own part within that window.

A block is read for an anchor only where its bounds meet a slot and its labels may fit. Anchors go to parts (runs of blocks)
in tiles; a part's blocks meet at most about ``TURN`` anchors at a time, so a task holds one part and so many anchors, whatever
the size of the table. Floors rise while blocks are read. The slots' rows of all parts meet in a window by score and id.

How much the bounds spare depends on the data: vectors without structure in many dimensions have bounds that exclude nothing,
and then every anchor reads every block, as in a plain search by blocks.

Rows with a null id, label or vector, or a null or non-finite component take no part, nor do rows where the anchor condition is
null as anchors. Equal rows (id, label, vector, anchor) count once; rows of one id that differ are rows of their own, but no row is
another row to an anchor of its own id. Vectors meet those of the same number of components only. Ties go to the smaller id. An
empty table, or one without anchors, gives no rows. A score or component beyond 62 bits is an error. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carbonloom.llm.chunks import get, kinds, put, table
from carbonloom.llm.shared import stored

#: Rows of a block, blocks of a part, anchors of a tile, zone maps of a slice.
BLOCK, PART, TILE, SLICE = 256, 256, 512, 4096
#: Anchors that a part's blocks meet at a time, about; rows of slots held before all but the best k go.
TURN, HELD = 16_384, 400_000
#: Levels of the Hilbert curve.
BITS = 3
_LEAST, _MOST = -(1 << 62), 1 << 62
_INDEX = "part long, block int, dims int, n int, ids binary, labels binary, rows binary, low binary, high binary, own binary, floors binary"
_SENT = "part long, turn int, dims int, ids binary, labels binary, rows binary, homes binary, floors binary, caps binary, blocks binary, need binary"
_TILE = "home long, dims int, n int, ids binary, labels binary, rows binary, homes binary, floors binary, caps binary"


def _put_ints(a: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold them all."""
    top = int(np.abs(a).max()) if a.size else 0
    kind = next(k for k in ("i1", "i2", "i4", "i8") if top < 1 << (8 * int(k[1]) - 1))
    return kind.encode() + put(a.astype(kind))


def _get_ints(data: bytes, width: int = 0) -> np.ndarray:
    a = get(data[2:], data[:2].decode()).astype(np.int64)
    return a.reshape(-1, width) if width else a


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Rows of non-negative cell numbers below 2**bits to places on the Hilbert curve, as rows of bytes that sort alike.

    Level by level from the top, each dimension's bit says whether the first one is mirrored or exchanged with it below that
    level (Skilling, "Programming the Hilbert curve", 2004); a Gray code over the dimensions then orders the halves.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    level = 1 << (bits - 1)
    while level > 1:
        below = np.uint32(level - 1)
        for i in range(len(x)):
            up = (x[i] & level) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(up, below, swap).astype(np.uint32)
            x[i] ^= swap
        level >>= 1
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.uint32)
    for k in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> k & 1, (1 << k) - 1, 0).astype(np.uint32)
    x ^= turn
    by_level = np.stack([x >> k & 1 for k in range(bits - 1, -1, -1)])  # level, dimension, row
    return np.packbits(by_level.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)


def _keys(values: np.ndarray) -> list[bytes]:
    """Curve places by direction: cells of half a standard deviation, for vectors of any length."""
    if not values.shape[1]:
        return [b""] * len(values)
    x = values.astype(np.float64)
    spread = np.sqrt((x * x).mean(1, keepdims=True))
    half = 1 << (BITS - 1)
    cells = np.clip(np.floor(2 * x / np.where(spread > 0, spread, 1)), -half, half - 1) + half
    return [k.tobytes() for k in hilbert_keys(cells, BITS)]


def _quantised(df: DataFrame, scale: int) -> DataFrame:
    """(dims, key, id, label, anchor, row) of every row that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.asarray(lists.value_lengths().fill_null(-1))
            flat = lists.flatten()
            x = np.floor(scale * np.asarray(flat.cast(pa.float64()).fill_null(np.nan)).astype(np.float64))
            bad = ~np.isfinite(x)
            ends = np.cumsum(np.maximum(sizes, 0))
            starts = ends - np.maximum(sizes, 0)
            spoilt = np.concatenate(([0], np.cumsum(bad)))
            good = (sizes >= 0) & (spoilt[ends] == spoilt[starts])
            if (np.abs(x[~bad]) >= _MOST).any():
                raise OverflowError("a component times the scale passes 62 bits")
            for dims in np.unique(sizes[good]):
                at = np.flatnonzero(good & (sizes == dims))
                values = x[starts[at][:, None] + np.arange(dims)].astype(np.int64)
                columns = [
                    pa.array(np.full(len(at), dims), pa.int32()),
                    pa.array(_keys(values), pa.binary()),
                    *(batch.column(c).take(pa.array(at)) for c in ("id", "label", "anchor")),
                    pa.array([v.astype("<i8").tobytes() if wide else v.astype("<i2").tobytes() for v, wide in zip(values, (np.abs(values) >= 1 << 15).any(1))], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["dims", "key", "id", "label", "anchor", "row"])

    return df.mapInArrow(run, "dims int, key binary, id long, label long, anchor boolean, row binary")


def _matrix(rows: list[bytes], dims: int) -> np.ndarray:
    kinds_ = {len(r) for r in rows}
    if kinds_ <= {2 * dims}:
        return np.frombuffer(b"".join(rows), "<i2").astype(np.int64).reshape(len(rows), dims)
    return np.array([np.frombuffer(r, "<i2" if len(r) == 2 * dims else "<i8").astype(np.int64) for r in rows]).reshape(len(rows), dims)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if top < 1 << 24:
        return (a.astype(np.float32) @ b.T.astype(np.float32)).astype(np.int64)
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < _MOST:
        return a @ b.T
    out = a.astype(object) @ b.T.astype(object)
    if max(abs(int(out.max())), abs(int(out.min()))) >= _MOST:
        raise OverflowError("a score passes 62 bits")
    return out.astype(np.int64)


def _bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that each row of ``a`` can have with vectors between each row of ``low`` and of ``high``."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    size = max((int(np.abs(x).max()) if x.size else 0) for x in (low, high)) * (int(np.abs(a).max()) if a.size else 0) * max(a.shape[1], 1)
    if size >= 1 << 52:  # no bounds where they would not be exact
        return np.full((len(a), len(low)), _LEAST), np.full((len(a), len(low)), _MOST)
    return _scores(up, low) + _scores(down, high), _scores(up, high) + _scores(down, low)


class Anchors:
    """Some anchors with their slots; ``floors`` and ``caps`` have a row per anchor, a column per slot."""

    def __init__(self, ids, labels, rows, homes, floors, caps):
        self.ids, self.labels, self.rows, self.homes, self.floors, self.caps = ids, labels, rows, homes, floors, caps

    def take(self, at) -> Anchors:
        return Anchors(*(x[at] for x in (self.ids, self.labels, self.rows, self.homes, self.floors, self.caps)))

    def packed(self) -> tuple:
        flat = (self.ids, self.labels, self.rows, self.homes, self.floors, self.caps)
        return tuple(_put_ints(x.reshape(-1)) for x in flat)

    @staticmethod
    def unpacked(row: dict, slots: int) -> Anchors:
        ids = _get_ints(row["ids"])
        shape = {"rows": (len(ids), row["dims"]), "floors": (len(ids), slots), "caps": (len(ids), slots)}
        rest = [_get_ints(row[c]).reshape(shape.get(c, (len(ids),))) for c in ("labels", "rows", "homes", "floors", "caps")]
        return Anchors(ids, *rest)

    @staticmethod
    def joined(parts: list[Anchors]) -> Anchors:
        return Anchors(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("ids", "labels", "rows", "homes", "floors", "caps")))


def best_of_blocks(blocks: list[tuple], anchors: Anchors, need: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, score, id): the best ``k`` rows of each slot among the blocks (ids, labels, rows) that ``need`` names per anchor.

    Slot number anchor * slots + column. Raises the anchors' floors as slots fill.
    """
    slots = anchors.floors.shape[1]
    slot, score, ids = (np.zeros(0, np.int64) for _ in range(3))
    fresh: list[tuple] = []
    waiting = 0

    def settle() -> None:
        nonlocal slot, score, ids, waiting
        slot, score, ids = (np.concatenate(x) for x in zip((slot, score, ids), *fresh))
        fresh.clear()
        waiting = 0
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        full = place == k - 1
        floors = anchors.floors.reshape(-1)
        floors[slot[full]] = np.maximum(floors[slot[full]], score[full])
        keep = place < k
        slot, score, ids = slot[keep], score[keep], ids[keep]

    anchors.floors = np.ascontiguousarray(anchors.floors)
    for b, (own_ids, own_labels, rows) in enumerate(blocks):
        wanted = np.flatnonzero(need[:, b])
        for begin in range(0, len(wanted), 4096):
            who = wanted[begin : begin + 4096]
            found = _scores(anchors.rows[who], rows)
            fits = (anchors.labels[who][:, None] == own_labels) == same
            fits &= anchors.ids[who][:, None] != own_ids
            for column in range(slots):
                a, r = np.nonzero(fits & (found >= anchors.floors[who, column][:, None]) & (found <= anchors.caps[who, column][:, None]))
                if len(a):
                    fresh.append((who[a] * slots + column, found[a, r], own_ids[r]))
                    waiting += len(a)
            if waiting > HELD:
                settle()
    settle()
    return slot, score, ids


def index(df: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int, positives: int) -> DataFrame:
    """The stored table of blocks (block 0, 1, … of a part) and of tiles of anchors (block -1) with the floors of their first slots."""
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector_col).alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    order = ["dims", "key", "id", "label", "row", "anchor"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _quantised(rows, scale).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    form = kinds(_INDEX)

    def finish(held: list[tuple], part: int) -> pa.RecordBatch:
        dims = held[0][0]
        ids, labels = (np.array([r[i] for r in held], np.int64) for i in (2, 3))
        values, marked = _matrix([r[4] for r in held], dims), np.array([r[5] for r in held])
        out, blocks = [], []
        for b, a in enumerate(range(0, len(held), BLOCK)):
            cut = slice(a, a + BLOCK)
            own = values[cut]
            blocks.append((ids[cut], labels[cut], own))
            packed = [_put_ints(x.reshape(-1)) for x in (ids[cut], labels[cut], own, own.min(0), own.max(0), np.unique(labels[cut]))]
            out.append((part, b, dims, len(own), *packed, None))
        at = np.flatnonzero(marked)
        for a in range(0, len(at), TILE):
            who = at[a : a + TILE]
            floors = np.full((len(who), 1), _LEAST)
            anchors = Anchors(ids[who], labels[who], values[who], who, floors, np.full((len(who), 1), _MOST))
            best_of_blocks(blocks, anchors, np.ones((len(who), len(blocks)), bool), positives, True)
            packed = [_put_ints(x.reshape(-1)) for x in (anchors.ids, anchors.labels, anchors.rows, anchors.homes)]
            out.append((part, -1, dims, len(who), *packed, None, None, _put_ints(anchors.floors.reshape(-1))))
        return table(out, form).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, last = TaskContext.get().partitionId() << 20, [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in order)):
                if row == last:
                    continue
                if held and (len(held) >= BLOCK * PART or row[0] != held[0][0]):
                    yield finish(held, number)
                    number, held = number + 1, []
                held.append(row)
                last = row
        if held:
            yield finish(held, number)

    return stored(rows.mapInArrow(run, _INDEX), "blocks")


def _slices(blocks: DataFrame, slices: int) -> DataFrame:
    """Zone maps packed into rows of about SLICE of them."""
    form = kinds("dims int, slice int, parts binary, blocks binary, low binary, high binary, own binary, owns binary")

    def run(zones: pa.Table) -> pa.Table:
        zones = zones.sort_by([("part", "ascending"), ("block", "ascending")])
        dims = zones["dims"][0].as_py()
        columns = {c: zones[c].to_pylist() for c in ("low", "high", "own")}
        low, high = (np.concatenate([_get_ints(x) for x in columns[c]]) for c in ("low", "high"))
        own = [_get_ints(x) for x in columns["own"]]
        packed = (np.asarray(zones["part"]), np.asarray(zones["block"]), low, high, np.concatenate(own), np.array([len(x) for x in own]))
        return table([(dims, zones["slice"][0].as_py(), *map(_put_ints, packed))], form)

    zones = blocks.select("part", "block", "dims", "low", "high", "own", F.pmod(F.xxhash64("part"), F.lit(slices)).cast("int").alias("slice"))
    return zones.groupBy("dims", "slice").applyInArrow(run, "dims int, slice int, parts binary, blocks binary, low binary, high binary, own binary, owns binary")


def _sent(tiles: DataFrame, blocks: DataFrame, slices: int, n_tiles: int, turns: int, slots: int, same: bool) -> DataFrame:
    """For each tile and part the anchors that must read some of its blocks, and which."""
    salts = max(1, min(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_tiles // 4))
    zones = _slices(blocks, slices).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    zones = zones.select("dims", "slice", "salt", *(F.col(c).alias(f"z_{c}") for c in ("parts", "blocks", "low", "high", "own", "owns")))
    named = tiles.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    mixed = F.xxhash64("home", "ids")
    named = named.withColumn("salt", F.pmod(mixed, F.lit(salts)).cast("int")).withColumn("turn", F.pmod(F.xxhash64(mixed), F.lit(turns)).cast("int"))
    form = kinds(_SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors = Anchors.unpacked(row, slots)
                parts, numbers = _get_ints(row["z_parts"]), _get_ints(row["z_blocks"])
                low, high = (_get_ints(row[f"z_{c}"]).reshape(len(parts), row["dims"]) for c in ("low", "high"))
                least, most = _bounds(anchors.rows, low, high)
                need = np.zeros(least.shape, bool)
                for s in range(slots):
                    need |= (most >= anchors.floors[:, s][:, None]) & (least <= anchors.caps[:, s][:, None])
                own, owns = _get_ints(row["z_own"]), _get_ints(row["z_owns"])
                of_block = np.repeat(np.arange(len(owns)), owns)
                for label in np.unique(anchors.labels):
                    fits = np.zeros(len(parts), bool)
                    fits[of_block[(own == label) == same]] = True
                    need[anchors.labels == label] &= fits
                out = []
                cuts = np.flatnonzero(np.diff(parts, prepend=parts[0] - 1))
                for a, b in zip(cuts, [*cuts[1:], len(parts)]):
                    cut = need[:, a:b]
                    who = np.flatnonzero(cut.any(1))
                    if len(who):
                        some = np.packbits(cut[who]).tobytes()
                        out.append((int(parts[a]), row["turn"], row["dims"], *anchors.take(who).packed(), _put_ints(numbers[a:b]), some))
                if out:
                    yield from table(out, form).to_batches()

    return named.join(zones, ["dims", "slice", "salt"]).mapInArrow(run, _SENT)


def _blocks_of(rows: pa.Table) -> tuple[list[tuple], dict[int, int]]:
    found = sorted((r for r in rows.to_pylist() if r["block"] >= 0), key=lambda r: r["block"])
    blocks = [(_get_ints(r["ids"]), _get_ints(r["labels"]), _get_ints(r["rows"]).reshape(r["n"], r["dims"])) for r in found]
    return blocks, {r["block"]: i for i, r in enumerate(found)}


def _read(blocks: DataFrame, sent: DataFrame, turns: int, slots: int, k: int, same: bool) -> DataFrame:
    """(home, anchor_id, slot, score, id): of every part, the best rows for each slot."""
    schema = "home long, anchor_id long, slot int, score long, id long"
    form = kinds(schema)
    wide = blocks.select("part", "block", "dims", "n", "ids", "labels", "rows").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return table([], form)
        own, place = _blocks_of(left)
        parts, needs = [], []
        for row in right.to_pylist():
            anchors = Anchors.unpacked(row, slots)
            at = [place[b] for b in _get_ints(row["blocks"]).tolist()]
            need = np.zeros((len(anchors.ids), len(own)), bool)
            need[:, at] = np.unpackbits(np.frombuffer(row["need"], np.uint8), count=len(anchors.ids) * len(at)).reshape(-1, len(at))
            parts.append(anchors)
            needs.append(need)
        anchors = Anchors.joined(parts)
        slot, score, ids = best_of_blocks(own, anchors, np.concatenate(needs), k, same)
        who, column = np.divmod(slot, slots)
        columns = (anchors.homes[who], anchors.ids[who], column, score, ids)
        return pa.Table.from_arrays([pa.array(c, f.type, safe=False) for c, f in zip(columns, form)], schema=form)

    return wide.groupBy("part", "turn").cogroup(sent.groupBy("part", "turn")).applyInArrow(run, schema)


def mine(
    df: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows where ``anchor`` holds: for each of an
    anchor's best ``positives`` of its label, the best ``negatives`` of other labels that score between ``low`` and ``high`` percent of it."""
    made = index(df, id_col, vector_col, label_col, anchor, scale, positives)
    counts = made.agg(
        F.count_if(F.col("block") >= 0).alias("blocks"), F.count_if(F.col("block") < 0).alias("tiles"), F.sum(F.when(F.col("block") < 0, F.col("n"))).alias("anchors")
    ).first()
    slices, turns = -(-max(counts.blocks, 1) // SLICE), -(-(counts.anchors or 1) // TURN)
    blocks, tiles = made.where("block >= 0"), made.where("block < 0")
    # an anchor's name: its part and place in it, as one number (a part has at most 2**16 rows)
    first_form, second_form = kinds(_TILE), kinds(_TILE)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, homes = _get_ints(r["ids"]), _get_ints(r["low"])
                names = (r["part"] << 16) + homes
                caps = np.full(len(ids), _MOST)
                out.append((r["part"], r["dims"], r["n"], r["ids"], r["labels"], r["rows"], _put_ints(names), r["floors"], _put_ints(caps)))
            if out:
                yield from table(out, first_form).to_batches()

    first = tiles.mapInArrow(opened, _TILE)
    sent = _sent(first, blocks, slices, counts.tiles, turns, 1, True)
    found = _read(blocks, sent, turns, 1, positives, True)
    order = Window.partitionBy("home").orderBy(F.desc("score"), "id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    best = stored(best.select("home", "place", "id", "score", F.shiftright("home", 16).alias("part")), "positives")

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        """The tiles of a part with a slot per positive, their floors raised by the part's own blocks."""
        if not right.num_rows:
            return table([], second_form)
        own, _ = _blocks_of(left)
        scores = {(h, p): s for h, p, s in zip(*(right[c].to_pylist() for c in ("home", "place", "score")))}
        out = []
        for r in left.to_pylist():
            if r["block"] >= 0:
                continue
            ids, names = _get_ints(r["ids"]), (r["part"] << 16) + _get_ints(r["low"])
            floors, caps = np.full((len(ids), positives), _MOST), np.full((len(ids), positives), _LEAST)
            for i, name in enumerate(names.tolist()):
                for p in range(positives):
                    score = scores.get((name, p + 1))
                    if score is not None:
                        floors[i, p], caps[i, p] = -(-low * score // 100), high * score // 100
            anchors = Anchors(ids, _get_ints(r["labels"]), _get_ints(r["rows"]).reshape(len(ids), r["dims"]), names, floors, caps)
            best_of_blocks(own, anchors, np.ones((len(ids), len(own)), bool), negatives, False)
            out.append((r["part"], r["dims"], r["n"], *anchors.packed()))
        return table(out, second_form)

    second = made.groupBy("part").cogroup(best.groupBy("part")).applyInArrow(windows, _TILE)
    second = stored(second, "windows")
    sent = _sent(second, blocks, slices, counts.tiles, turns, positives, False)
    found = _read(blocks, sent, turns, positives, negatives, False)
    order = Window.partitionBy("home", "slot").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = best.select("home", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(pairs, ["home", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
