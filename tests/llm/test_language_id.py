from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import language_id as m


@pytest.fixture(scope="module")
def model(documents):
    return m.fit_text_model(documents)


def brute(rows, model):
    """The fusion with plain loops over ``(text, declared, host)``."""
    names = [*model.languages, "und"]
    n = len(names)

    def soft(x):
        e = np.exp(np.array(x) - max(x))
        return e / e.sum()

    text = [model.evidence(t.encode() if t is not None else None, False) for t, _, _ in rows]
    share = [soft(t) for t in text]
    said = [None if d is None else d if d in names else "other" for _, d, _ in rows]
    host = [h.lower() if h else None for _, _, h in rows]
    domain = [h and ".".join(h.split(".")[-2:]) for h in host]
    suffix = [(h.split(".")[-1] or None) if h else "" for h in host]
    total = sum(share)
    overall = (total + 1) / (total.sum() + n)
    spoken = sum((s for s, d in zip(share, said, strict=True) if d), np.zeros(n))
    out = []
    for i in range(len(rows)):
        prior = overall
        for of, weight in ((domain, m.DOMAIN_WEIGHT), (host, m.HOST_WEIGHT)):
            same = sum((share[j] for j in range(len(rows)) if j != i and of[i] and of[j] == of[i]), np.zeros(n))
            prior = (same + weight * prior) / (same.sum() + weight)
        logs = np.array(text[i]) + np.log(prior)
        if host[i]:
            own = sum(share[j] for j in range(len(rows)) if host[j] and suffix[j] == suffix[i])
            logs += np.log((own + m.OTHER_WEIGHT * own.sum() / total.sum()) / (total + m.OTHER_WEIGHT))
        if said[i]:
            own = sum(share[j] for j in range(len(rows)) if said[j] == said[i])
            logs += np.log((own + m.OTHER_WEIGHT * own.sum() / spoken.sum()) / (spoken + m.OTHER_WEIGHT))
        post = soft(logs)
        best = int(np.argmax(post))
        speaks = any(x != 0 for x in text[i])
        out.append((names[best], round(float(post[best]), 6), speaks and names[best] != "und" and post[best] >= 0.5))
    return out


CASES = [
    ("the and of that with this from", "en", "a.b.org"),
    ("der die und nicht von einer", "de", "a.b.org"),
    ("la de les des que une", None, "a.b.org"),
    ("el de los que para una", "xx", "c.b.org"),
    ("the and of that with this from", "en", "a.b.org"),
    ("qu", "fr", "z.de"),
    ("", "fr", "z.de"),
    (None, None, None),
    ("12345 !!! ---", "en", ""),
    ("Ж" * 400, None, "z.de"),
    ("the thing " * 20_000, None, "a.b.org"),
]


def test_fusion_equals_brute_force(spark, model):
    rows = [(i, *c, "clash") for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id long, text string, lang string, host string, share string").repartition(3)
    found = m.identify(df, model, declared=F.col("lang"), host=F.col("host"))
    got = {r["doc"]["id"]: (r["language"], round(r["confidence"], 6), r["accepted"]) for r in found.collect()}
    expected = brute(CASES, model)
    for i, (language, confidence, accepted) in enumerate(expected):
        assert got[i][0] == language and got[i][2] == accepted, (i, got[i], expected[i])
        assert math.isclose(got[i][1], confidence, abs_tol=2e-6)
    assert found.schema["doc"].dataType.names == ["id", "text", "lang", "host", "share"]


def test_labelled_documents_are_recognised(documents):
    kept = m.with_known_language(documents)
    assert kept.columns == documents.columns
    assert kept.count() == documents.count()


def test_held_out_accuracy(documents):
    learn, test = documents.where("doc_id % 3 > 0"), documents.where("doc_id % 3 = 0")
    found = m.identify(test, m.fit_text_model(learn), host=F.col("source"))
    right = found.where(F.col("doc.lang") == F.col("language")).count()
    assert right >= 0.98 * test.count()


def test_copies_do_not_thin_the_sample(spark):
    rows = [("hola que tal", "es")] * 3000 + [(f"uno{i} dos tres", "es") for i in range(40)]
    rows += [(f"one{i} two three", "en") for i in range(40)]
    df = spark.createDataFrame(rows, "text string, lang string")
    once = m.fit_text_model(df.distinct(), sample=30)
    model = m.fit_text_model(df, sample=30)
    for text in (b"hola que tal", b"uno7 dos tres", b"one7 two three", b"quatro"):
        assert model.evidence(text, False) == once.evidence(text, False)
    spanish, none = model.languages.index("es"), len(model.languages)
    assert model.evidence(b"dos tres", False)[spanish] > model.evidence(b"dos tres", False)[none]


def test_every_labelled_language_is_modelled(spark, monkeypatch):
    word = lambda i, k: "".join(chr(0x4E00 + 40 * i + (7 * k + j) % 40) for j in range(6))
    rows = [(f"{word(i, k)} {word(i, k + 1)} " * 8, f"l{i:03}", f"h{i % 9}.org") for i in range(90) for k in range(3 if i else 9)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    kept = m.with_known_language(df)
    assert kept.count() == len(rows) and kept.select("lang").distinct().count() == 90
    model = m.fit_text_model(df)
    assert isinstance(model.table, m.Sparse)
    monkeypatch.setattr(m, "DENSE", 1000)
    dense = m.fit_text_model(df)
    for text in (rows[0][0], rows[100][0], "abc " + rows[50][0] * 1000):
        assert np.allclose(model.evidence(text.encode(), False), dense.evidence(text.encode(), False), atol=1e-6)
    found = m.identify(df, model, declared=F.col("lang"), host=F.col("source"))
    assert found.where("doc.lang != language or not accepted").count() == 0


def test_empty_tables(spark, documents, model):
    none = documents.limit(0)
    assert m.identify(none, model, declared=F.col("lang"), host=F.col("source")).count() == 0
    unknown = m.fit_text_model(none)
    assert {r["language"] for r in m.identify(documents.limit(3), unknown).collect()} == {"und"}


def test_pages(spark, sf_dir):
    rows = m.query(spark, sf_dir).collect()
    assert len(rows) == 250 and sum(r["language"] == r["declared"] for r in rows) > 240
