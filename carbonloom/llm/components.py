"""Connected components of similar rows, without ever listing all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carbonloom.llm import chunks as ch
from carbonloom.llm.shared import folder, let_go


def saved(df: DataFrame) -> DataFrame:
    """``df`` cut off from its lineage, in the shared folder of ``spark.checkpoint.dir``; an own one only where unset."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder(df.sparkSession))
    out = df.checkpoint(eager=True)
    let_go(df.sparkSession)  # rounds would else outrun the driver's collector
    return out


#: Links that a task takes at most into its union-find.
LINKS = 1 << 17


def _forests(links: DataFrame, roots: bool = False) -> DataFrame:
    """A union-find over each task's links: links of every node to the smallest of its tree; with ``roots``, also of those to themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        a = np.array(list(parent), np.int64)
        b = np.array([root(x) for x in a.tolist()], np.int64)
        keep = (a != b) | roots
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in_")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in_").alias("in_"))
    return nodes.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in_") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node it is connected with.

    Union-find in tasks of up to ``LINKS`` links first, which is all if one takes them; else the forests' links are pulled to smaller
    nodes by alternating steps (every node passes its smallest neighbour to the larger ones, then to the smaller ones) until each
    component is a star. The minimum of a node's neighbours combines before the shuffle, so a hub costs no
    task more.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    tasks = -(-links.count() // LINKS)
    if tasks <= 1:
        return _forests(links.coalesce(1), roots=True).toDF("node", "component")
    links = saved(_forests(links.repartition(tasks)).distinct())
    while not _stars(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # to the larger neighbours: each is linked to the smallest that this node knows
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # to the smaller neighbours and itself
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        links = saved(small.where("a <> b").distinct())
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.toDF("node", "component").union(roots)


#: Hub rounds at most, pairs per posting from which one more is worth it, and hubs of a key in the last round.
ROUNDS, WORTH, HUBS = 2, 4, 12
#: Nodes of a key that are compared with all its nodes in one group of the last join.
SPLIT = 512
#: 64-bit words of a set's bitmap.
WORDS = 32


def bitmaps(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For n sets of distinct hashes (``owner``: the set of each): (n x WORDS) long, the bits that a set's hashes fall on, and
    how many of its elements hide behind the bit of another one."""
    bits = np.zeros((n, WORDS * 64), bool)
    bits[owner, (hashes >> np.uint64(32)).astype(np.int64) % (WORDS * 64)] = True
    return np.packbits(bits, axis=1).view(np.int64), np.bincount(owner, minlength=n) - bits.sum(1)


def sketch(rows: DataFrame, size: str, spare: str, words: str) -> DataFrame:
    """(node, size, spare, w0, …): what :func:`may_share` reads, none of it null."""
    zero = F.lit(0).cast("long")
    each = (F.coalesce(F.get(words, i), zero).alias(f"w{i}") for i in range(WORDS))
    return rows.select(F.coalesce("node", zero).alias("node"), *(F.coalesce(F.col(c).cast("long"), zero).alias(n) for c, n in ((size, "size"), (spare, "spare"))), *each)


def may_share(percent: int, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Whether two sets can reach ``percent`` by their sizes and bitmaps: they share at most an element for each common bit, and those
    that hide behind a bit of another element (``spare``)."""
    common = sum((F.bit_count(x(f"w{i}").bitwiseAND(y(f"w{i}"))) for i in range(1, WORDS)), F.bit_count(x("w0").bitwiseAND(y("w0"))))
    common = common + F.least(x("spare"), y("spare"))
    return (100 + percent) * common >= percent * (x("size") + y("size"))


def linked_groups(
    postings: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sketches: DataFrame,
    percent: int,
    near: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
) -> DataFrame:
    """(node, component) over all verified links between nodes that share a key; nodes without a link are absent.

    ``postings`` has (key, node) and what ``near`` reads: a condition on two postings of a key, given as functions
    from column name to column, that holds for at least one shared key of every pair that links, and still does where a column
    is less. ``verify`` takes
    distinct pairs (a, b) and returns those that link. ``sketches``: see :func:`sketch`.

    A key's nodes are not paired with each other. In a round every key has a hub (by hash, another one each round), and
    every node is paired with the hub it shares most keys with, unless they are connected. Keys whose nodes are all
    connected are done. In the last round keys have ``HUBS`` hubs, and nodes meet all of them whose sizes and bitmaps
    leave room for ``percent``. After the rounds, what is left are keys whose nodes are alike, but mostly not alike enough: there
    a pair comes out of the join only if the nodes are not connected, and sizes and bitmaps leave room for
    ``percent``; keys of many nodes are split among many groups. Those pairs are verified, so no link between
    components is lost.
    """
    more = [c for c in postings.columns if c not in ("key", "node")]
    now, comps, links = postings.withColumn("comp", F.col("node")), None, None
    for turn in range(ROUNDS + 1):
        if turn:
            # a key that is done stays done, and after the first time those of the same nodes are one
            rows = postings if turn == 1 else now.drop("comp")
            named = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
            ends = [F.min("comp").alias("x"), F.max("comp").alias("y")]
            if turn == 1:
                # keys of the same nodes are one key: with its least values, ``near`` lets no less through
                same = (F.bit_xor(F.xxhash64("node", F.lit(seed))) for seed in (1, 2))
                keys = named.groupBy("key").agg(*ends, F.count("*").alias("_group"), F.xxhash64(*same, F.count("*")).alias("_set"))
                now = named.join(keys.where("x <> y").select("key", "_group", "_set"), "key")
                now = now.groupBy(F.col("_set").alias("key"), "node", "comp", "_group").agg(*(F.min(c).alias(c) for c in more))
            else:
                now = named.join(named.groupBy("key").agg(*ends).where("x <> y").select("key"), "key")
            now = saved(now)
            total = now.agg(F.count("*").alias("n"), F.sum("_group").alias("pairs")).first()
            if not total.n:
                break
        last = turn and (turn == ROUNDS or total.pairs <= WORTH * total.n)
        if last:
            pairs = _open_pairs(now, sketches, percent, near)
        elif turn == ROUNDS - 1:
            pairs = _hub_pairs(now, sketches, percent, near, turn)
        else:
            rank = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
            hubs = now.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "node", "comp", *more)).alias("hub"))
            pairs = now.join(hubs, "key").where("comp <> hub.comp")
            if near is not None:
                pairs = pairs.where(near(F.col, lambda c: F.col(f"hub.{c}")))
            pairs = pairs.groupBy(F.col("node").alias("a"), F.col("hub.node").alias("b")).agg(F.count("*").alias("n"))
            pairs = pairs.groupBy("a").agg(F.max(F.struct("n", "b")).alias("best")).select("a", "best.b")
        found = saved(verify(pairs))
        if comps is None or not found.isEmpty():
            links = found if links is None else links.union(found)
            comps = saved(components(links))
        if last:
            break
    return comps


#: Nodes of a key up to which all are compared with each other as arrays.
SMALL = 128
#: Pairs whose bitmaps are compared together.
_PAIRS = 1 << 14


def linked_sets(
    postings: DataFrame,
    first: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sketches: DataFrame,
    percent: int,
    near: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    groups: int,
) -> DataFrame:
    """As :func:`linked_groups`, where a key stands for a set of nodes already, ``first`` has the pairs of the first round, and pairs of
    keys that are left out of ``postings`` are all among them.

    Nodes of an open key of up to ``SMALL`` nodes are compared with each other as arrays, in ``groups`` groups of keys, and
    those that are not connected and whose sizes and bitmaps leave room for ``percent`` are verified: that settles the key. Larger
    keys take the rounds of :func:`linked_groups`, the last two."""

    def opened(rows: DataFrame) -> DataFrame:
        named = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        keys = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("_group"))
        return named.join(keys.where("x <> y").select("key", "_group"), "key")

    links = saved(verify(first))
    comps = saved(components(links))
    now = saved(opened(postings))
    large = now.where(F.col("_group") > SMALL)
    pairs = _close_pairs(now.where(F.col("_group") <= SMALL), sketches, percent, groups)
    more = not large.isEmpty()
    if more:
        pairs = pairs.union(_hub_pairs(large, sketches, percent, near, ROUNDS - 1))
    found = saved(verify(pairs.distinct()))
    if not found.isEmpty():
        links = links.union(found)
        comps = saved(components(links))
    if more:
        found = saved(verify(_open_pairs(opened(large.drop("comp", "_group")), sketches, percent, near)))
        if not found.isEmpty():
            comps = saved(components(links.union(found)))
    return comps


def _close_pairs(now: DataFrame, sketches: DataFrame, percent: int, groups: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a key, are not connected and may be ``percent`` alike, distinct in each of ``groups`` groups of keys."""
    rows, _ = _with_sketches(now, sketches)
    words = F.array(*(f"w{i}" for i in range(WORDS))).alias("words")
    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("group"), "key", "node", "comp", "size", "spare", words)

    def run(table: pa.Table) -> pa.Table:
        key, node, comp, size, spare = (table[c].to_numpy() for c in ("key", "node", "comp", "size", "spare"))
        bits = table["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)  # of signed numbers, the sign would not be counted
        nodes, place, of = np.unique(node, return_index=True, return_inverse=True)
        order = np.argsort(key, kind="stable")
        own = of[order]
        begin = ch.runs(key[order])
        count = np.diff(np.append(begin, len(key)))
        left = np.repeat(begin + count, count) - np.arange(len(key))  # postings of the key from here on
        comp, size, spare, bits = comp[place], size[place], spare[place], bits[place]
        met, ahead = [np.zeros(0, np.int64)], 1
        i = np.flatnonzero(left > ahead)
        while len(i):  # each with the one so many places further in its key
            x, y = own[i], own[i + ahead]
            keep = (comp[x] != comp[y]) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
            x, y = x[keep], y[keep]
            met.append(np.unique(np.minimum(x, y) * len(nodes) + np.maximum(x, y)))
            ahead += 1
            i = i[left[i] > ahead]
        x, y = np.divmod(np.unique(np.concatenate(met)), len(nodes))
        room = np.zeros(len(x), bool)
        for a in range(0, len(x), _PAIRS):
            p, q = x[a : a + _PAIRS], y[a : a + _PAIRS]
            common = np.bitwise_count(bits[p] & bits[q]).sum(1, dtype=np.int64) + np.minimum(spare[p], spare[q])
            room[a : a + _PAIRS] = (100 + percent) * common >= percent * (size[p] + size[q])
        return pa.table({"a": nodes[x[room]], "b": nodes[y[room]]})

    return rows.groupBy("group").applyInArrow(run, "a long, b long")


def _room(percent: int, near) -> Column:
    """Whether a posting and one with columns named …_b may link and are not connected."""

    def second(c: str) -> Column:
        return F.col(f"{c}_b")

    room = (F.col("comp") != second("comp")) & may_share(percent, F.col, second)
    return room if near is None else room & near(F.col, second)


def _with_sketches(now: DataFrame, sketches: DataFrame) -> tuple[DataFrame, list[str]]:
    rows = now.drop("size").join(sketches, "node")
    return rows, [c for c in rows.columns if c not in ("key", "_group")]


def _hub_pairs(now: DataFrame, sketches: DataFrame, percent: int, near, turn: int) -> DataFrame:
    """Pairs of every node with the hubs of its keys. A node meets a hub once, however many keys they share: a posting takes its
    key's hubs along in one row, and bitmaps are compared for the distinct hubs of a node."""
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("node", F.lit(turn)), "node"))
    hub = F.struct(*(c for c in now.columns if c not in ("key", "_group")))
    hubs = now.withColumn("_place", first).where(F.col("_place") <= HUBS).groupBy("key").agg(F.collect_list(hub).alias("hubs"))

    def open_(x: Column) -> Column:
        apart = F.col("comp") != x["comp"]
        return apart if near is None else apart & near(F.col, lambda c: x[c])

    met = now.join(hubs, "key").select("node", F.transform(F.filter("hubs", open_), lambda x: x["node"]).alias("hubs"))
    met = met.where(F.size("hubs") > 0).groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("hubs"))).alias("hubs"))
    rows = met.join(sketches, "node").withColumn("node_b", F.explode("hubs")).drop("hubs")
    other = sketches.toDF(*(f"{c}_b" for c in sketches.columns))
    pairs = rows.join(other, "node_b").where(may_share(percent, F.col, lambda c: F.col(f"{c}_b")))
    return pairs.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def _open_pairs(now: DataFrame, sketches: DataFrame, percent: int, near) -> DataFrame:
    """Distinct pairs (a, b) of unconnected nodes that share an open key and may be ``percent`` alike."""
    rows, kept = _with_sketches(now, sketches)
    rows = rows.withColumn("_splits", F.ceil(F.col("_group") / SPLIT).cast("int"))
    one = rows.withColumn("_split", F.pmod(F.xxhash64("node"), F.col("_splits")).cast("int"))
    other = rows.withColumn("_split", F.explode(F.sequence(F.lit(0), F.col("_splits") - 1)))
    other = other.select("key", "_split", *(F.col(c).alias(f"{c}_b") for c in kept))
    pairs = one.join(other, ["key", "_split"]).where((F.col("comp") < F.col("comp_b")) & _room(percent, near))
    return pairs.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()
