from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import ann as m


def exact(rows, k=20):
    usable = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, x in usable:
        if q % 20 == 0:
            scored = sorted(((-float((x * v).sum()), i) for i, v in usable if i != q))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df, **options):
    got = {}
    for r in sorted(m.nearest(df, F.col("id") % 20 == 0, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return got


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, id string, score int")


@pytest.fixture
def small_packs(monkeypatch):
    """Many buckets, packs, parts and blocks on a small table."""
    for name, value in (("SMALL", 64), ("PACK", 300), ("BLOCK", 16)):
        monkeypatch.setattr(m, name, value)


def test_recall_with_clusters(spark, small_packs):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.standard_normal(16)).astype(np.float32)) for i in range(2500)]
    got, expected = found(frame(spark, rows)), exact(rows)
    assert set(got) == set(expected)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in expected])
    assert recall >= 0.9
    for q in expected:
        assert len(got[q]) == 20
        assert got[q] == sorted(got[q], key=lambda r: (-r[1], r[0]))


def test_probes_visit_the_likeliest_buckets_first():
    h = m.Hashes.drawn(200_000, 4, 0.5, 1.0, 2, 0.9)
    place = np.array([0.1, 2.9, -1.6, 7.4, 0.2, 3.3])[: h.a.shape[1]]
    slots = h.probes(place)
    assert (np.abs(slots[0] - np.floor(place)) <= 1).all()
    assert len({tuple(s) for s in slots}) == len(slots)

    def chance(s):
        edges = (np.array([s, s + 1]) - place) * h.width / h.radius
        return np.prod(np.diff(m._normal(edges), axis=0))

    chances = [chance(s) for s in slots]
    assert all(a >= b - 1e-12 for a, b in zip(chances, chances[1:], strict=False))
    assert sum(chances) >= h.share > sum(chances[:-1])


def test_one_vector_holds_a_third(spark, small_packs):
    rng = np.random.default_rng(1)
    hot = rng.standard_normal(8).astype(np.float32)
    rows = [(i, hot if i % 3 == 0 else rng.standard_normal(8).astype(np.float32)) for i in range(1800)]
    got, expected = found(frame(spark, rows)), exact(rows)
    for q in expected:
        if q % 3 == 0:
            assert [i for i, _ in got[q]] == [i for i, _ in expected[q]]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0, 0]), (5, [nan, 1]), (6, [inf, 1]), (7, [1, 2, 3]),
            (20, [1, 0]), (None, [1, 0]), (8, [1, 0]), (8, [1, 0])]
    df = frame(spark, rows).union(spark.sql("select 9l, array(1f, null), 'x', 1"))
    got = found(df)
    assert got == {0: [(8, 1.0), (20, 1.0), (1, 0.5)], 20: [(0, 1.0), (8, 1.0), (1, 0.5)]}
    assert found(df.limit(0)) == {}
    assert found(frame(spark, [(0, [1, 0])])) == {}


def test_long_vectors_against_short_ones(spark, small_packs):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(12) * rng.uniform(0.5, 2)).astype(np.float32)) for i in range(1500)]
    got, expected = found(frame(spark, rows)), exact(rows)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in expected])
    assert recall >= 0.9


def test_many_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [1.0] + [float(i == j) for j in range(200)]) for i in rng.permutation(200)]
    assert found(frame(spark, rows)) == exact(rows)
