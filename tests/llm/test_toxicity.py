from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import toxicity as m


def auc(score, label):
    score, label = np.array(score), np.array(label)
    a, b = score[label == 1][:, None], score[label == 0][None, :]
    return ((a > b).mean() + 0.5 * (a == b).mean()).item()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    plain = [f"w{i}rd".replace("0", "o") for i in range(300)] + "you we they house tree river".split()
    plain = [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in plain]
    rude = ["grobulant", "fnordish", "zibber"]
    rows, labels = [], []
    for i in range(900):
        words = list(rng.choice(plain, rng.integers(20, 60)))
        toxic = i % 5 == 0
        if toxic:
            for at in rng.integers(0, len(words), 3):
                words.insert(at, str(rng.choice(rude)))
        rows.append((i, " ".join(words), "src", 0.5))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_words_learnt_from_labels(corpus):
    docs, labels = corpus
    rows = m.fitted(docs, labels)(docs, row=F.col("doc_id")).join(labels, F.col("doc") == F.col("doc_id")).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc"]).encode()) % 5 == 0]
    assert auc([r["score"] for r in held], [r["toxic"] for r in held]) > 0.99
    assert sum((r["score"] >= 0.5) != r["toxic"] for r in held) <= 0.03 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_documents(spark, sf_dir):
    found = m.query(spark, sf_dir)
    rows = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)
    assert auc([r["score"] for r in held], [r["toxic"] for r in held]) > 0.85
    assert found.count() == 1000


def test_labels_of_held_out_rows_are_not_read(spark, corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(m.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = m.fitted(docs, labels)(docs, row=F.col("doc_id")).collect()
    b = m.fitted(docs, turned)(docs, row=F.col("doc_id")).collect()
    assert {r["doc"]: r["score"] for r in a} == {r["doc"]: r["score"] for r in b}


def test_awkward_rows(spark, corpus):
    docs, labels = corpus
    score = m.fitted(docs, labels)
    odd = [(None, "grobulant you fnordish zibber"), (1, None), (2, ""), (3, "a " * 200_000), (3, "a " * 200_000), (4, "!!!")]
    rows = score(spark.createDataFrame(odd, "doc_id long, text string")).collect()
    by = [(r["doc"]["doc_id"], r["score"]) for r in rows]
    assert len(by) == 6 and by[1][1] == by[2][1] and by[3] == by[4]
    assert by[0][1] > by[3][1]
    assert score(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("labels", "expected"), [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, None)], 0.0)])
def test_without_two_classes(spark, labels, expected):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "doc_id long, text string")
    score = m.fitted(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["score"] for r in score(docs).collect()} == {expected}


def test_filter_keeps_columns(corpus):
    docs, labels = corpus
    kept = m.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()}
    assert sum(i % 5 == 0 for i in gone) >= 0.95 * 180 and sum(i % 5 != 0 for i in gone) <= 8


def test_features():
    known = m.Lexicon(["zibb*", "rude"])
    names = m.FEATURES
    row = dict(zip(names, known.features(b"You are a z1bber, RUDE! i d i o t s p a zibberish"), strict=True))
    assert row["hidden_density"] > 0 and row["second_person_nearness"] > 0 and row["capital_words"] > 0
    assert dict(zip(names, known.features(b"plain words"), strict=True))["lexicon_hits"] == 0
    assert known.features(None) == [0.0] * len(names)


def plain_features(text, listed_terms):
    """The thirteen features word by word, each from its definition."""
    marks = """!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""
    words = text.split()
    if not words:
        return [0.0] * 13
    whole = {t for t in listed_terms if t[-1] != "*"} | set(m.INSULTS)
    stems = [t[:-1] for t in listed_terms if t[-1] == "*"]
    leet = dict(zip("013457@$!|+", "oieastasiit", strict=True))

    def listed(word):
        return word in whole or any(word.startswith(s) and len(s) in (4, 5, 6) for s in stems)

    seeds, hits, hidden, second, capital, odd, single = [], [], [], [], [], [], []
    for i, word in enumerate(words):
        core = word.strip(marks)
        low = core.lower()
        letters = [c for c in core if c.isalpha()]
        if low.isalpha():
            if listed(low):
                hits.append(i)
            if low in m.INSULTS:
                seeds.append(i)
            if low in m.SECOND_PERSON:
                second.append(i)
            if len(core) > 2 and core == core.upper() and core != core.lower():
                capital.append(i)
            if len(core) == 1:
                single.append(i)
        elif letters and any(not c.isalpha() and c not in "-'’" for c in core):
            odd.append(i)
            if listed("".join(c for c in (leet.get(c, c) for c in low) if c.isalpha())):
                hidden.append(i)
    spelled, run = 0, []
    for i in range(len(words) + 1):
        if i in single:
            run.append(words[i].strip(marks).lower())
            continue
        spelled += len(run) >= 4 and listed("".join(run))
        run = []
    found = sorted(hits + hidden)
    near = [1 / (1 + min(abs(i - j) for j in second) / 5) for i in found] if second else []
    raw = text.encode()
    ascii_letters = [c for c in text if c.isascii() and c.isalpha()]
    n = len(words)
    return [
        len(seeds) / n, len(found) / n, np.log(1 + len(found)), (len(hidden) + spelled) / n, sum(near) / len(near) if near else 0.0,
        sum(c.isupper() for c in ascii_letters) / max(1, len(ascii_letters)), len(capital) / n, text.count("!") / n, text.count("?") / n,
        sum(c in marks for c in text) / len(raw), (text.count("!!") + text.count("??") + text.count("***")) / n, len(odd) / n, np.log(1 + n),
    ]


def test_features_from_their_definitions(documents):
    terms = ["zib*", "grob*", "fnordi*", "river", "house", "casa*", "und", "the"]
    texts = [r["text"][:4000] for r in documents.where("doc_id % 7 = 0").collect()]
    texts += ["", " ", "You ID10T you!! f o o l s t o p", "f o o l", "F O O L? you", "1d10t $cum", "!!! ***", "don't it-s x", "É STUPID Stupid", "gr0bular you",
              "a b c d house h o u s e", "you river river you " * 30]
    lexicon = m.Lexicon(terms)
    for text in texts:
        assert lexicon.features(text.encode()) == pytest.approx(plain_features(text, terms)), text[:80]
    assert sum(f[1] > 0 for f in map(lexicon.features, map(str.encode, texts))) > 20


def isotonic(x, y):
    """Least-squares rising curve by pooling, at the distinct x."""
    at = sorted(set(x))
    pools = [[np.mean([b for a, b in zip(x, y, strict=True) if a == v]), sum(a == v for a in x), 1] for v in at]
    i = 0
    while i + 1 < len(pools):
        if pools[i][0] > pools[i + 1][0] + 1e-15:
            (a, n, k), (b, w, j) = pools[i], pools[i + 1]
            pools[i : i + 2] = [[(a * n + b * w) / (n + w), n + w, k + j]]
            i = max(0, i - 1)
        else:
            i += 1
    return at, [mean for mean, _, k in pools for _ in range(k)]


def test_scores_are_the_calibrated_ones(corpus, monkeypatch):
    """The curve pooled by hand from the raw scores of the calibrating fold."""
    docs, labels = corpus
    noisy = labels.withColumn("toxic", F.when(F.col("doc_id") % 17 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    parts = {}
    for tie in (0.0, 1.0, m.TIE):
        monkeypatch.setattr(m, "TIE", tie)
        parts[tie] = {r["doc"]: r["score"] for r in m.fitted(docs, noisy)(docs, row=F.col("doc_id")).collect()}
    even, raw, score = parts[0.0], parts[1.0], parts[0.01]
    truth = {r["doc_id"]: r["toxic"] for r in noisy.collect()}
    fold = [i for i in raw if zlib.crc32(str(i).encode()) % 5 == 4]
    at, curve = isotonic([raw[i] for i in fold], [truth[i] for i in fold])
    assert 0 < min(c for c in curve if c) and len(set(curve)) > 2
    for i in raw:
        assert even[i] == pytest.approx(float(np.interp(raw[i], at, curve)), abs=1e-9)
        assert score[i] == pytest.approx(0.99 * even[i] + 0.01 * raw[i])
