from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from ebbtide.llm import ngram_join as m
from ebbtide.llm.graph import components


def sets(texts):
    out = []
    for t in texts:
        w = t.encode().translate(m.LOWER).split() if t else []
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows):
    """``rows`` are (id, text); set sizes and components by comparing all pairs."""
    own = sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(own[i] & own[j])
            if own[i] and 100 * both >= 75 * len(own[i] | own[j]):
                parent[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    least = {k: min((rows[i][0] for i in v if rows[i][0] is not None), default=None) for k, v in members.items()}
    return Counter((rows[i][0], len(own[i]), least[find(i)]) for i in range(len(rows)))


def frame(spark, rows, parts=5):
    schema = "doc_id long, text string, node string, n int, token long, bucket string"
    return spark.createDataFrame([(*r, "clash", 1, 2, "b") for r in rows], schema).repartition(parts)


def joined(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in m.join_components(df).collect())


def changed(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"z{rng.random()}"
    return words


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (None, "one two"), (7, "é É"),
            (8, "é é"), (9, "a b c d e"), (9, "a b c d e"), (9, "f g h i j"), (10, "long " * 50_000), (11, "LONG " * 49_000 + "end"),
            (12, "a b c d e"), (13, "\x1c one two")]
    assert joined(frame(spark, rows)) == brute(rows)


def test_chains_copies_and_common_passages(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    passage = [word() for _ in range(60)]
    for _ in range(40):  # share most of their words, but are no near copies
        rows.append([word() for _ in range(40)] + passage)
    for _ in range(40):
        rows.append(passage + [word() for _ in range(rng.randrange(4, 16))])
    base = [word() for _ in range(150)]
    rows += [changed(rng, base, rng.randrange(0, 8)) for _ in range(60)]
    chain = [word() for _ in range(120)]
    for _ in range(25):  # neighbours link, the ends don't
        chain = changed(rng, chain, 2)
        rows.append(chain)
    rows += [[word() for _ in range(rng.randrange(1, 30))] for _ in range(100)]
    rows += [rows[3]] * 80 + [rows[90]] * 5
    texts = [(i, " ".join(w)) for i, w in enumerate(rows)]
    rng.shuffle(texts)
    assert joined(frame(spark, texts)) == brute(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_copies(spark, seed, monkeypatch):
    monkeypatch.setattr(m, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(m, "FLUSH", 2000)
    rng = random.Random(seed)
    bases = [[f"v{rng.randrange(300)}" for _ in range(rng.randrange(5, 80))] for _ in range(25)]
    rows = []
    for i in range(260):
        base = rng.choice(bases)
        rows.append((i, " ".join(changed(rng, base, rng.randrange(0, 1 + len(base) // 15)))))
    assert joined(frame(spark, rows)) == brute(rows)


def test_orders_never_lose_a_link():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, 6))).astype(np.uint64)]))
        both, all_ = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        assert m.linked(a, b) == (len(b) > 0 and 100 * both >= 75 * all_)


def test_one_per_group(spark):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(5, near + " x"), (3, near), (3, near), (8, near + " y"), (1, "other text"), (None, "other text"), (None, None), (9, "alone here"), (2, "")]
    df = frame(spark, rows)
    kept = m.one_per_group(df)
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(3, near), (1, "other text"), (None, None), (9, "alone here"), (2, "")]
    )


def test_empty_table(documents):
    assert m.join_components(documents.limit(0)).count() == 0
    assert m.one_per_group(documents.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    rng = random.Random(5)
    names = [f"{rng.random():.12f}" for _ in range(400)]
    edges = [(names[i], names[i + 1]) for i in range(0, 299)] + [(names[i], names[300]) for i in range(301, 400)]
    edges += [edges[0], (names[1], names[0]), (names[5], names[5])]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert len(found) == 400
    assert len({found[n] for n in names[:300]}) == 1 and len({found[n] for n in names[300:]}) == 1
    assert found[names[0]] != found[names[300]]


def test_bitmap_holds_every_key(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 1, -1, 2**62, -(2**62), 32767, 32768, 8388607)], "key long")
    held = m._bitmap(keys, "key")
    for (k,) in keys.collect():
        at = k % (1 << 23)
        assert held[at // 8] >> (at % 8) & 1
    assert int(np.unpackbits(held).sum()) == len({r["key"] % (1 << 23) for r in keys.collect()})


def test_groups_of_hot_tokens_are_not_expanded(spark):
    """A third of the rows are near copies; candidate pairs stay in proportion."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(changed(rng, base, 2) if i % 3 == 0 else [f"q{rng.random()}" for _ in range(30)])) for i in range(1500)]
    sizes, staged = {}, m.staged

    def watched(df, name):
        out = staged(df, name)
        sizes[name] = out.count()
        return out

    try:
        m.staged = watched
        found = joined(frame(spark, rows))
    finally:
        m.staged = staged
    assert len({c for _, _, c in found}) == 1001
    assert sizes["stars"] + sizes["rest"] < 2000


def test_extra_columns_do_not_matter(few):
    plain = few.select("doc_id", "text")
    assert joined(plain) == joined(few.withColumn("root", F.lit(1)))


def test_copies_are_no_group_of_a_worker(spark, monkeypatch):
    """Only packed tokens go through ``applyInArrow``; rows of copies and null texts don't."""
    sizes, apply = [], GroupedData.applyInArrow

    def watched(self, func, schema):
        sizes.append(self._df.count())
        return apply(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", watched)
    rows = [(i, "a copy of one text") for i in range(3000)] + [(i, None) for i in range(3000, 6000)]
    rows += [(i, f"another text number {i} here") for i in range(9000, 9100)]
    found = joined(frame(spark, rows, 3))
    assert found == Counter((i, int(t is not None), 0 if i < 3000 else i) for i, t in rows)
    assert len(sizes) == 2 and max(sizes) < 100
