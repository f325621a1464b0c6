import itertools
import math
import random

import numpy as np
import pytest
from carbonloom.llm import hard_negatives
from conftest import CLASHES
from pyspark.sql import functions as F


def mined(rows, by=100, positives=5, negatives=10):
    """All result rows, sorted, of rows (vec_id, embedding, label)."""
    good = {
        (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for a, label, q in good:
        if a % by:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, r)), i, m) for i, m, r in good if i != a and len(r) == len(q))
        for p, pid, _ in [s for s in scores if s[2] == label][:positives]:
            hits = [s for s in scores if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out += [(a, pid, rank + 1, i, -p, -s) for rank, (s, i, _) in enumerate(hits)]
    return sorted(out)


def vectors(seed, n, dims, labels=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[n // 3 : n // 2] = x[0] + rng.normal(size=(n // 2 - n // 3, dims)) * 0.05  # a crowd
    x[n // 2 : n // 2 + 20] = x[1]  # equal vectors
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, v, int(rng.integers(labels))) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]


def results(df, by=100, **more):
    got = hard_negatives.mine(df, F.col("vec_id") % by == 0, **more)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


ODD = [
    (None, [1.0, 0.0], 1), (500, None, 1), (600, [1.0, None], 1), (700, [float("nan"), 1.0], 1), (800, [float("inf"), 1.0], 1), (900, [1.0, 0.5], None),
    (1000, [], 1), (1100, [], 1), (1200, [], 2), (1300, [0.5], 1), (1301, [0.4], 1), (1302, [0.3], 2), (1400, [0.0, 0.0], 1), (1401, [2000.0, -900.0], 2), (1402, [-2000.0, 3.0], 1),
]


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    if small:  # many blocks, parts, tiles, slices and turns
        for name, value in (("BLOCK", 4), ("PART", 3), ("TILE", 2), ("SLICE", 5), ("TURN", 6), ("HELD", 10)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(3, 200, 5) + ODD
    rows += rows[:15] + [(20, rows[30][1], 0), (20, rows[31][1], 1), (40, rows[40][1], (rows[40][2] + 1) % 3)]  # repeats, and ids with two vectors or labels
    df = spark.createDataFrame([(*r, *[None] * 12) for r in rows], f"vec_id long, embedding array<float>, label int, {CLASHES}").repartition(3)
    want = mined(rows, by=20)
    assert len(want) > 300 and results(df, by=20) == want
    assert results(df, by=20, positives=2, negatives=3) == mined(rows, 20, 2, 3)


def test_wide_values_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(21) + rng.random() for _ in range(4)], i % 2) for i in range(40)]
    rows += [(40 + i, [2.0**20 + 1 / 256, float(i)], i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    good = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows}
    assert max(abs(x) for _, _, v in good for x in v) > 1 << 27
    rows32 = [(i, [x / 256 for x in v], label) for i, label, v in good]
    again = [(i, [float(x) for x in v], label) for i, v, label in rows32]
    want = []
    for a, label, q in good:
        if a % 10 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, r)), i, m) for i, m, r in good if i != a and len(r) == len(q))
            for p, pid, _ in [s for s in scores if s[2] == label][:5]:
                hits = [s for s in scores if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
                want += [(a, pid, rank + 1, i, -p, -s) for rank, (s, i, _) in enumerate(hits)]
    assert want and results(df, by=10) == sorted(want)
    assert results(spark.createDataFrame(again, df.schema), by=10) == sorted(want)


def test_without_rows_or_anchors(spark):
    df = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert results(df) == [] and results(df.limit(0)) == []


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 3), (3, 2), (5, 1), (4, 2)])
def test_curve_goes_from_cell_to_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in hard_negatives.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_spare_blocks():
    rng = np.random.default_rng(5)
    rows = np.rint(np.concatenate([rng.normal(size=(64, 6)) * 10 + c for c in rng.normal(size=(20, 6)) * 200])).astype(np.int64)
    rows = rows[sorted(range(len(rows)), key=hard_negatives._keys(rows).__getitem__)]
    blocks = rows.reshape(-1, 16, 6)
    a = rows[::50]
    least, most = hard_negatives._bounds(a, blocks.min(1), blocks.max(1))
    scores = np.einsum("ad,brd->abr", a, blocks)
    assert (least <= scores.min(2)).all() and (most >= scores.max(2)).all()
    best = np.sort((a @ rows.T), axis=1)[:, -10]
    assert (most >= best[:, None]).mean() < 0.3
