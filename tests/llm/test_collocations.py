from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import collocations as m


def brute(docs, top, least=m.LEAST):
    """All phrases counted and ranked in one place."""
    counts = defaultdict(Counter)
    for lang, text in docs:
        found = counts["und" if lang is None else lang]
        lowered = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]", piece) if w]
            for size in (1, 2, 3):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        total = sum(c for p, c in found.items() if len(p) == 1)
        rows = []
        for p, a in found.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(10**6 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if len(p) == 2 and any(100 * c >= 50 * a for q, c in found.items() if len(q) == 3 and c >= least and p in (q[:2], q[1:])):
                continue
            rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def corpus(seed, langs=("en", "de", None), docs=60):
    rng = random.Random(seed)
    words = [f"{c}{i}" for c in "aBé" for i in range(12)]
    weights = [1 / (i + 1) for i in range(len(words))]
    made = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(("new york city", "on the other hand", "a0 a1")) if rng.random() < 0.2 else rng.choices(words, weights)[0])
        text = "".join(p + rng.choice((" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\r\n", ":", "\x0b")) for p in parts)
        made.append((rng.choice(langs), text))
    return [*made, ("en", None), ("fr", ""), ("", "a a a a a a a a a a a a")]


def answer(df, top):
    return sorted(tuple(r) for r in m.collocations(df, top=top).collect())


@pytest.mark.parametrize(("seed", "top", "first"), [(1, 2000, 2), (2, 3, 1), (3, 7, 1), (4, 1, 1), (5, 20, 4)])
def test_against_brute_force(spark, monkeypatch, seed, top, first):
    """Few wanted rows make several rounds."""
    monkeypatch.setattr(m, "FIRST", first)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    assert answer(df, top) == brute(docs, top)


def test_slices_and_flushes(monkeypatch):
    """Phrases that cross the ends of slices and flushes are counted once."""
    monkeypatch.setattr(m, "SLICE", 40)
    docs = [(lang, t) for lang, t in corpus(7) if lang and t]
    every = np.full(1 << (m.BITS - 6), 2**64 - 1, np.uint64)
    for flush in (1, 2, 7, 50, 10**6):
        monkeypatch.setattr(m, "FLUSH", flush)
        for size in (1, 2, 3):
            counter, found = m.Counter(size, [every] * 3), Counter()
            batches = [b for lang, t in docs for b in counter.add(lang, t.encode())] + list(counter.flush())
            for batch in batches:
                for lang, phrase, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    found[lang, phrase.decode()] += c
            expected = Counter()
            for lang, text in docs:
                for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda c: c[0].lower(), text)):
                    words = [w for w in re.split("[ \t]", piece) if w]
                    expected.update((lang, " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
                    if size == 1:
                        expected[lang, ""] += len(words)
            assert found - Counter() == expected - Counter()


def test_a_hit_by_chance_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(m, "BITS", 6)  # one cell: nearly every phrase hits
    docs = corpus(8)
    assert answer(spark.createDataFrame(docs, "lang string, text string"), 5) == brute(docs, 5)


def test_exact_scores_beyond_64_bits(spark):
    rows = [(10**13 + 1, 10**13 + 3, 10**13 + 7), (9_999_999_999, 10**12, 10**12 - 1), (10, 10, 10)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(m.score("a", "l", "r")).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in rows]


def test_empty_table_bytes_and_more_columns(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert m.collocations(none).collect() == []
    bad = spark.createDataFrame([("en", "X y " * 12, 1)], "lang string, text string, phrase int")
    bad = bad.withColumn("text", F.concat(F.col("text"), F.expr("cast(x'ff' as string)")))
    got = m.collocations(bad).collect()
    assert [(r.phrase, r.a, r.n) for r in got] == [("x y x", 11, 25), ("y x y", 11, 25)]
