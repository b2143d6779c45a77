from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import hard_negatives as m

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, anchor):
    """Every pair scored in whole numbers."""
    whole = {}
    for key, label, v in rows:
        if key is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        whole[key] = min(whole.get(key, row), row)
    out = []
    for a, (label, v) in whole.items():
        if a % anchor:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), k, other) for k, (other, w) in whole.items() if k != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            found = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(a, positive, rank, k, -p, -s) for rank, (s, k, _) in enumerate(found, 1)]
    return sorted(out)


def answer(spark, rows, anchor):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "v": F.lit(1), "part": F.lit(2)})
    return sorted(tuple(r) for r in m.hard_negatives(df, F.col("id") % anchor == 0).collect())


def vectors(seed, n, dim, centres=6, spread=0.4, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dim))
    at = rng.integers(0, centres, n)
    v = (middle[at] + spread * rng.standard_normal((n, dim))) * rng.uniform(0.01, 1, (n, 1))
    return [(int(i), int(rng.integers(labels)), [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize(("seed", "n", "dim", "anchor"), [(1, 900, 8, 30), (2, 400, 3, 10), (3, 300, 32, 7), (4, 60, 1, 5)])
def test_against_brute_force(spark, monkeypatch, seed, n, dim, anchor):
    """Small parts and blocks, so that results of several tasks are merged."""
    monkeypatch.setattr(m, "PART", 128 * dim)
    monkeypatch.setattr(m, "BLOCK", 64 * dim)
    rows = vectors(seed, n, dim)
    found = answer(spark, rows, anchor)
    assert found and found == brute(rows, anchor)


def test_odd_rows_ties_and_one_frequent_label(spark):
    rng = random.Random(9)
    rows = vectors(5, 300, 4, labels=2)
    rows = [(k, 1 if rng.random() < 0.7 else label, rows[0][2] if rng.random() < 0.3 else v) for k, label, v in rows]
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, [1.0] * 4), (1000, None, [1.0] * 4), (1010, 1, None), (1020, 1, [None, 1.0, 1.0, 1.0]), (1030, 2, [nan, 0.0, 0.0, 0.0]),
           (1040, 2, [inf, 0.0, 0.0, 0.0]), (1050, 1, []), (1060, 1, [0.0] * 4), (1070, 2, [0.0] * 4), (1080, 1, [0.001] * 4)]
    rows += odd + rows[:50]
    assert answer(spark, rows, 10) == brute(rows, 10)
    assert answer(spark, [], 10) == [] and answer(spark, [(0, 1, [1.0])], 10) == []
    other_length = [*vectors(6, 40, 4), (500, 1, [1.0, 2.0])]
    assert answer(spark, other_length, 10) == brute(other_length[:-1], 10)


def test_bounds_hold_and_filter(spark):
    """Every score lies within the bounds of its row and tile, and most rows of clustered
    vectors need no score."""
    rows = vectors(11, 2000, 16, centres=12, spread=0.1)
    v = np.floor(256 * np.array([r[2] for r in rows]))
    v[0], v[1], v[2] = 0, v[5], -v[6]
    directions = v[[10, 20, 30, 40, 50, 60, 70, 80]]
    directions = directions / m.norms(directions)[:, None]
    angles, norms = m.angles(v, directions), m.norms(v)
    part = m.Part.of(pa.table({"id": range(2000), "label": [r[1] for r in rows], "v": list(v), "angles": list(angles), "norm": norms}))
    needed = []
    for i in range(0, 2000, 40):
        scores = part.scores(np.arange(2000), v[i], norms[i])
        assert scores.tolist() == [int(x) for x in (part.v @ v[i])]
        low, high = part.rows(np.arange(2000), angles[i], norms[i])
        assert (low <= scores).all() and (scores <= high).all()
        tile_low, tile_high = part.tiles(angles[i], norms[i])
        assert (np.repeat(tile_low, m.TILE)[:2000] <= scores).all() and (scores <= np.repeat(tile_high, m.TILE)[:2000]).all()
        top = np.sort(scores)[-5]
        needed.append(((low <= 0.9 * top) & (high >= 0.3 * top)).mean() if top > 0 else 0)
    assert np.mean(needed) < 0.6


def test_windows_are_exact():
    positive = np.array([-10, 0, 1, 7, 10, 333, 10**12 + 1])
    least, most = m.window(positive)
    for p, low, high in zip(positive.tolist(), least.tolist(), most.tolist(), strict=True):
        for s in {low - 1, low, high, high + 1}:
            assert (low <= s <= high) == (30 * p <= 100 * s <= 90 * p)


def test_scores_beyond_doubles_are_exact():
    rows, v = np.array([[2.0**40 + 1, 3.0], [2.0**30, -1.0]]), np.array([2.0**20 + 1, 2.0**50 + 1])
    most = float(m.norms(rows).max() * m.norms(v[None])[0])
    assert m.inner(rows, v, most).tolist() == [sum(int(x) * int(y) for x, y in zip(r, v, strict=True)) for r in rows]
    with pytest.raises(OverflowError):
        m.inner(np.array([[2.0**40]]), np.array([2.0**40]), 2.0**80)
