from __future__ import annotations

import re

from ebbtide.llm import decontaminate as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text)) if text else []


def brute(docs, items):
    out = []
    for text in docs:
        own, hit, found = split(text), set(), set()
        for item, words in ((i, split(t)) for i, t in items):
            n = min(13, len(words))
            windows = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
            for k in range(len(own) - n + 1) if n else ():
                if tuple(own[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        out.append((len(own), len(hit), sorted(found)))
    return out


ITEMS = [
    (1, " ".join(f"w{i}" for i in range(30))),
    (2, "short One"),
    (10, "short one"),
    (3, None),
    (4, " .,- "),
    (5, "É1 é1 ß"),
    (6, " ".join(["same"] * 20)),
]
DOCS = [
    None,
    "",
    "--- !",
    "a SHORT, one b",
    " ".join(f"w{i}" for i in range(5, 25)),
    " ".join(f"w{i}" for i in range(12)),
    "x " * 500 + " ".join(f"W{i}" for i in range(30)) + " y short one",
    "same " * 40,
    "É1_é1-ß É1 É1 ß",
    "word " * 100_000 + "short one",
    "a SHORT, one b",
]


def frames(spark, docs=DOCS, items=ITEMS):
    rows = [(i, t, "clash", 7) for i, t in enumerate(docs)]
    d = spark.createDataFrame(rows, "doc_id long, text string, items string, n_words int")
    return d, spark.createDataFrame(items, "item_id long, text string")


def result(df):
    return {r["doc"]["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in df.collect()}


def test_equals_brute_force(spark):
    assert result(m.scan(*frames(spark))) == dict(enumerate(brute(DOCS, ITEMS)))


def test_blocks_of_the_benchmark(spark):
    assert result(m.scan(*frames(spark), block_bytes=80)) == dict(enumerate(brute(DOCS, ITEMS)))


def test_documents_and_spans_removed(spark):
    docs, items = frames(spark)
    kept = m.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    counts = brute(DOCS, ITEMS)
    expected = {i for i, (n, h, _) in enumerate(counts) if not (h and 20 * h >= n)}
    assert {r["doc_id"] for r in kept.collect()} == expected
    cut = m.without_spans(docs, items)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[3] == "a  b" and texts[0] is None and texts[5] == DOCS[5]
    assert all(h == 0 for _, h, _ in brute([texts[i] for i in (3, 4, 6, 9)], ITEMS))


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert m.scan(docs.limit(0), items).count() == 0
    assert all(r["n_hit"] == 0 for r in m.scan(docs, items.limit(0)).collect())
