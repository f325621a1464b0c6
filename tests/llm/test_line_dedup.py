import random

import brute
import numpy as np
import pyarrow as pa
import xxhash
from carbonloom.llm import chunks as ch
from carbonloom.llm import components, line_dedup
from pyspark.sql import functions as F


def test_lines(docs, texts):
    want = brute.deduplicated(texts)
    got = line_dedup.dedup(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_counts_and_emptied_rows(docs, texts):
    want = brute.deduplicated(texts)
    for r in line_dedup.dedup(docs, counts=True).collect():
        assert r.n_lines == len(brute.lines(texts[r.doc_id]))
        assert r.n_lines - r.n_removed == len(brute.lines(want[r.doc_id]))
    kept = {r.doc_id for r in line_dedup.dedup(docs, drop_emptied=True).collect()}
    assert kept == {k for k, t in texts.items() if not brute.lines(t) or brute.lines(want[k])}


def test_repeated_rows_and_empty(spark, nothing):
    df = spark.createDataFrame([(1, "one line here"), (1, "one line here"), (None, "one line here\nother")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup(df).collect())
    assert got == [(0, "one line here\nother"), (1, ""), (1, "")]
    assert line_dedup.dedup(nothing).count() == 0


def test_one_changed_byte_in_a_short_line(spark):
    # 46 bytes: 37 of 47 five-byte shingles are shared, but only 31 of 47 eight-byte ones
    line = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJ"
    df = spark.createDataFrame([(1, line), (2, line[:20] + "#" + line[21:])], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup(df, counts=True).collect()} == {1: 0, 2: 1}


def recall(seed=3, pairs=3000, least=75, below=78):
    """The part of the pairs of lines at ``least`` to ``below`` % similarity that share a band, and how many pairs."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz      "
    lines = []
    while len(lines) < 2 * pairs:
        line = "".join(rng.choice(letters) for _ in range(rng.randrange(40, 300)))
        other = list(line)
        for _ in range(max(1, round(len(line) / 35))):
            other[rng.randrange(len(line))] = "#"
        a, b = line.strip().encode(), "".join(other).strip().encode()
        s, t = line_dedup.shingle_set(a), line_dedup.shingle_set(b)
        if least * len(s | t) <= 100 * len(s & t) < below * len(s | t):
            lines += [a, b]
    bands = line_dedup.signatures(lines)
    return float((bands[::2] == bands[1::2]).any(1).mean()), pairs


def test_recall_at_the_threshold():
    assert recall()[0] >= 0.995


def test_shingles_are_of_characters(spark):
    # 60 characters of three bytes each: one changed character leaves 52 of 60 shingles
    line = "".join(chr(0x4E00 + 7 * i) for i in range(60))
    df = spark.createDataFrame([(1, line), (2, line[:30] + "é" + line[31:]), (3, line[:26] + "abcdefgh" + line[34:])], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup(df, counts=True).collect()} == {1: 0, 2: 1, 3: 0}


def test_bitmaps_bound_what_sets_share(spark):
    rng = random.Random(9)
    lines = []
    for _ in range(60):
        base = [rng.choice("abcdefgh ") for _ in range(rng.choice([6, 40, 200, 900]))]
        for share in (1, 0.9, 0.7, 0.5):
            lines.append("".join(c if rng.random() < share ** 0.2 else "#" for c in base).encode())
    sizes, spare, words = line_dedup._sketches(lines)
    assert sizes == [len(line_dedup.shingle_set(x)) for x in lines]
    rows = [(i, *x) for i, x in enumerate(zip(sizes, spare, words))]
    df = spark.createDataFrame(rows, "node long, size int, spare int, words array<long>")
    df = components.sketch(df, "size", "spare", "words").withColumn("key", F.floor(F.col("node") / 4))
    other = df.select("key", *(df[c].alias(f"{c}_b") for c in df.columns if c != "key"))
    kept = {(r.node, r.node_b) for r in df.join(other, "key").where(components.may_share(75, F.col, lambda c: F.col(f"{c}_b"))).collect()}
    alike = 0
    for i, a in enumerate(lines):
        for j in range(i - i % 4, i - i % 4 + 4):
            s, t = line_dedup.shingle_set(a), line_dedup.shingle_set(lines[j])
            alike += i != j and 100 * len(s & t) >= 75 * len(s | t)
            assert (i, j) in kept or 100 * len(s & t) < 75 * len(s | t)
    assert alike > 20 and len(kept) < 0.9 * 4 * len(lines)


def _join_rows(plan):
    """Rows out of every join of a plan that has run without adaptive execution."""
    own = [plan.metrics().apply("numOutputRows").value()] if "Join" in plan.nodeName() else []
    children = plan.children()
    return own + [n for i in range(children.size()) for n in _join_rows(children.apply(i))]


def test_a_hub_is_met_once_however_many_keys_are_shared(spark):
    nodes, keys = 40, 30
    postings = spark.range(keys).withColumnRenamed("id", "key").crossJoin(spark.range(nodes).withColumnRenamed("id", "node"))
    now = postings.select("key", "node", F.col("node").alias("comp"), F.lit(nodes).alias("_group"), F.lit(50).alias("size"))
    words = F.array(*[F.lit(7).cast("long")] * components.WORDS)
    sketches = spark.range(nodes).select(F.col("id").alias("node"), F.lit(60).alias("size"), F.lit(0).alias("spare"), words.alias("words"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = components._hub_pairs(now, components.sketch(sketches, "size", "spare", "words"), 75, lambda x, y: x("size") == y("size"), 1)
        found = {(r.a, r.b) for r in pairs.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    hubs = {x for x in range(nodes) if sum(x in p for p in found) == nodes - 1}
    assert len(hubs) == components.HUBS and found == {(a, b) for b in range(nodes) for a in range(b) if {a, b} & hubs}
    assert max(_join_rows(pairs._jdf.queryExecution().executedPlan())) <= nodes * keys


def test_rounds_after_the_first_two_read_open_keys_only(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    # nodes of a key are alike, but for a few keys of ten kinds each
    rows = [(key, 10 * key + i) for key in range(300) for i in range(4)] + [(1000 + key, 10 * i + 5) for key in range(5) for i in range(10)]
    postings = spark.createDataFrame([(k, n, 10) for k, n in rows], "key long, node long, size int").mapInArrow(counted, "key long, node long, size int")
    nodes = spark.createDataFrame([(n,) for n in {n for _, n in rows}], "node long")
    full = F.array_repeat(F.lit(-1).cast("long"), components.WORDS)
    sketches = components.sketch(nodes.select("node", F.lit(10).alias("size"), F.lit(10).alias("spare"), full.alias("words")), "size", "spare", "words")
    found = components.linked_groups(postings, lambda pairs: pairs.select("a", "b").where("a div 10 = b div 10"), sketches, 75)
    got = {r.node: r.component for r in found.collect()}
    assert got == {n: n // 10 * 10 for _, n in rows if n < 3000 and n % 10 != 5}
    assert read.value <= 4 * len(rows)  # twice to find the first hubs, and twice to find which keys are open


def test_packed_keys_come_back():
    rng = np.random.default_rng(3)
    for keys in (np.zeros(0, np.uint64), np.array([7], np.uint64), np.array([0, 0, 1 << 63], np.uint64), np.sort(rng.integers(0, 1 << 40, 5000).astype(np.uint64))):
        assert ch.get_keys(ch.put_keys(keys)).tolist() == keys.tolist()
        assert ch.get_planes(ch.put_planes(keys), np.uint64).tolist() == keys.tolist()


def _asked(texts, buckets=3):
    """The question of each chunk, given its texts, by bucket."""
    blocks = {}
    for chunk, own in enumerate(texts):
        rows = line_dedup._question(buckets)(pa.table({"id": pa.array(range(len(own)), pa.int64()), "text": pa.array(own, pa.string())}))
        for bucket, *rest in rows:
            blocks.setdefault(bucket, []).append({"chunk": chunk} | dict(zip(("keys", "numbers", "tags", "lines"), rest)))
    return blocks


def test_a_band_takes_few_bytes():
    """Its key, its line's number and tag took 7.4 bytes; the hashes of the lines come on top now."""
    rng = np.random.default_rng(4)
    texts = ["\n".join("".join(map(chr, rng.integers(97, 123, 90))) for _ in range(10)) for _ in range(400)]
    blocks = [b for own in _asked([texts]).values() for b in own]
    assert sum(len(b[k]) for b in blocks for k in ("keys", "numbers", "tags", "lines")) < 6.8 * 4000 * line_dedup.BANDS


def test_lines_of_several_chunks_are_named_to_all_of_them():
    texts = [["one line of its own\nthis line is in two chunks"], ["this line is in two chunks\nthis line is in two chunks"], ["something else altogether"]]
    told = [row for blocks in _asked(texts).values() for row in line_dedup._shared_bands(blocks)]
    shared = np.array([xxhash.xxh3_64_intdigest(b"this line is in two chunks")], np.uint64).view(np.int64)[0]
    assert sorted((chunk, node) for chunk, _, _, again in told for node in again) == [(0, shared), (1, shared)]
    assert not any(keys for _, keys, _, _ in told)


def test_lines_that_occur_once_and_share_no_band_are_not_looked_up(spark, monkeypatch):
    """Each distinct line of each chunk was a row of three exchanges."""
    written = []
    stored = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: written.append(stored(df, name)) or written[-1])
    rows = [(i, f"{chr(97 + i) * 40}\nthe same line in every text") for i in range(20)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(i, t if i == 0 else t.split("\n")[0]) for i, t in rows]
    own = written[0].where("nodes IS NOT NULL").collect()
    assert len({n for r in own for n in r.nodes}) == 1


def test_alike_counts_shingles_as_sets_do():
    rng = random.Random(6)
    base = ["short", "ab", "é", "aaaaaaaaaaaa", "x" * 40 + "日本語のテキスト" * 3, "the quick brown fox jumps over the lazy dog " * 4]
    pairs = [(a, b) for a in base for b in base]
    for _ in range(300):
        a = "".join(rng.choice("abcdé日 ") for _ in range(rng.randrange(1, 90)))
        b = list(a)
        for _ in range(rng.randrange(4)):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        pairs.append((a, "".join(b)))
    x, y = ([p[i].encode() for p in pairs] for i in (0, 1))
    for percent in (60, 75, 100):
        want = []
        for a, b in zip(x, y):
            s, t = line_dedup.shingle_set(a), line_dedup.shingle_set(b)
            want.append(100 * len(s & t) >= percent * len(s | t))
        assert line_dedup.alike(x, y, percent).tolist() == want
    assert 20 < sum(want) < len(want) and line_dedup.alike([], []).tolist() == []


def test_bands_of_the_same_lines_are_one_key_and_a_pair_meets_through_its_hub(spark, monkeypatch):
    """Every shared band of a line was a posting of its own: some 20 for a pair of near copies."""
    written = []
    stored = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: written.append(stored(df, name)) or written[-1])
    line = "one line of some length that is found in two texts, with a small change at its end only: "
    docs = spark.createDataFrame([(1, line + "a"), (2, line + "b"), (3, "nothing like it " * 5)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup(docs, counts=True).collect()} == {1: 0, 2: 1, 3: 0}
    rows = written[0].where("line IS NOT NULL").collect()
    assert len(rows) == 2 and sum(len(r.keys) for r in rows) <= 1
    assert [r.hub for r in rows if r.hub is not None] == [r.id for r in rows if r.hub is None]


def test_small_keys_are_compared_whole(spark):
    """All pairs of a key that are not connected and whose bitmaps leave room, also where a word's first bit is set."""
    rng = random.Random(11)
    sets = [rng.sample(range(60), 40) for _ in range(40)]
    sets += [s[:-2] + [60 + i, 80 + i] for i, s in enumerate(sets[:20])]
    hashes = np.array([(j * 34 + 56) << 32 for s in sets for j in s], np.uint64)
    words, spare = components.bitmaps(hashes, np.repeat(np.arange(60), 40), 60)
    assert (words < 0).any() and not spare.any()
    sketches = spark.createDataFrame([(i, 40, 0, w) for i, w in enumerate(words.tolist())], "node long, size int, spare int, words array<long>")
    rows = [(key, node, node // 2, 40) for key, n in enumerate((60, 5, 2)) for node in range(n)]
    now = spark.createDataFrame(rows, "key long, node long, comp long, size int")
    got = [(r.a, r.b) for r in components._close_pairs(now, components.sketch(sketches, "size", "spare", "words"), 75, 1).collect()]
    want = {(a, b) for b in range(60) for a in range(b) if a // 2 != b // 2 and 175 * len({*sets[a]} & {*sets[b]}) >= 75 * 80}
    assert len(got) == len(set(got)) and set(got) == want and 20 <= len(want) < 800


def _kept(spark, monkeypatch, small, lines):
    monkeypatch.setattr(components, "SMALL", small)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    return {r.doc_id for r in line_dedup.dedup(docs, counts=True).where("n_removed = 0").collect()}


def test_small_and_large_keys_give_the_same_groups(spark, monkeypatch):
    rng = random.Random(12)
    lines = []
    for _ in range(6):
        base = [rng.choice("abcdefgh ") for _ in range(120)]
        for _ in range(8):
            line = list(base)
            for _ in range(rng.randrange(1, 9)):
                line[rng.randrange(10, 110)] = rng.choice("xyz")
            lines.append("".join(line).strip())
    assert 6 < len(_kept(spark, monkeypatch, 1, lines)) < 48 and _kept(spark, monkeypatch, 1, lines) == _kept(spark, monkeypatch, 128, lines)


def test_components_need_one_task_up_to_a_bound(spark, monkeypatch):
    """A few links took several rounds of shuffles: the tasks' forests were of 10,000 links at most."""
    rng = random.Random(13)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(5).cache()
    one = {tuple(r) for r in components.components(links).collect()}
    assert "Aggregate" not in components.components(links)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(components, "LINKS", 100)
    assert {tuple(r) for r in components.components(links).collect()} == one
    assert {n for n, _ in one} == {x for a, b in pairs if a != b for x in (a, b)} and all((c, c) in one for _, c in one)
    links.unpersist()
