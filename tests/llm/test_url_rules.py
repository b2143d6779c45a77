from __future__ import annotations

import re
from collections import defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from ebbtide.llm import url_rules as m

FIXED = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def parts(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]) if found else ("", "")


def fixed(host, path):
    best = None
    for name, verdict in FIXED:
        h, p = name.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(name) > len(best[0])):
            best = name, verdict
    return best or (None, None)


def brute(rows, support, confidence):
    """``rows`` are (tokens, verdict or None); the verdict by plain counting."""
    labelled = [(t, v) for t, v in rows if v]
    counts, joint = defaultdict(int), defaultdict(int)
    for tokens, verdict in labelled:
        for k in (1, 2, 3):
            for c in combinations(sorted(tokens), k):
                counts[c] += 1
                joint[c, verdict] += 1
    rules = {
        (c, v): (round(j / counts[c], 9), round(j / len(labelled), 9))
        for (c, v), j in joint.items()
        if j / len(labelled) >= support and j / counts[c] >= confidence
    }
    out = []
    for tokens, verdict in rows:
        fits = [(*s, v == "block") for (c, v), s in rules.items() if set(c) <= set(tokens)]
        out.append(verdict or (("block" if max(fits)[2] else "allow") if fits else "allow"))
    return out


def test_query_equals_counting(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in m.judge(pages, min_support=0.05, min_confidence=0.8).collect()}
    url = F.col("url")
    token = {r["page_id"]: r["t"] for r in pages.select("page_id", m.tokens(url, m.host_of(url), m.path_of(url)).alias("t")).collect()}
    rows, ids = [], []
    for r in pages.collect():
        host, path = parts(r["url"])
        name, verdict = fixed(host, path)
        own = got[r["page_id"]]
        assert (own["host"], own["path"], own["rule"]) == (host, path, name)
        rows.append((token[r["page_id"]], verdict))
        ids.append(r["page_id"])
    expected = dict(zip(ids, brute(rows, 0.05, 0.8), strict=True))
    assert {i: got[i]["verdict"] for i in ids} == expected
    assert "block" in {expected[i] for i, (_, v) in zip(ids, rows, strict=True) if not v}


def test_parts_of_urls(spark):
    urls = [None, "", "abc", "http://", "x://HOST.Org", "http://a.ORG?x=/y", "http://Ä.org/ES/#f", "http://a://b/c", "h://a.com/de/\nq?z",
            "http://example.org/es/", "http://x.example.org/en/12", "http://notexample.org/es/a", "http://org/", "http://org", "//x/y"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for r in m.judge(df.union(df)).collect():
        host, path = parts(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, fixed(host, path)[0])


def test_empty_table_and_no_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert m.judge(none).count() == 0
    one = spark.createDataFrame([(None, "http://a.net/x" + "y" * 100_000)], none.schema)
    assert [r["verdict"] for r in m.judge(one).collect()] == ["allow"]


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = m.query(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def labelled(spark, baskets):
    return spark.createDataFrame([(sorted(t), v) for t, v in baskets], "tokens array<string>, verdict string")


def test_rules_over_merged_tokens_equal_counting(spark):
    """Tokens a, b always occur together, and so do c, d, e; the rules are those of counting
    every combination, but for redundant ones."""
    baskets = [("ab", "block")] * 6 + [("abx", "block")] * 3 + [("cdey", "allow")] * 5 + [("cdex", "block")] * 2 + [("abcde", "allow")] * 4
    baskets += [("x", "allow")] * 3 + [("", "block")] * 2
    df = labelled(spark, baskets)
    items = {tuple(r["members"]) for r in m.merged_tokens(df, 2).collect()}
    assert items == {("a", "b"), ("c", "d", "e"), ("x",), ("y",)}
    counts, joint = defaultdict(int), defaultdict(int)
    for tokens, verdict in baskets:
        for k in (1, 2, 3):
            for c in combinations(sorted(tokens), k):
                counts[c] += 1
                joint[c, verdict] += 1
    kept = {(c, v): (round(j / counts[c], 9), round(j / len(baskets), 9)) for (c, v), j in joint.items() if j >= 2 and j / counts[c] >= 0.5}
    needed = {
        (c, v): s for (c, v), s in kept.items()
        if not any(set(d) < set(c) and w == v and t[0] >= s[0] for (d, w), t in kept.items())
    }
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["support"]) for r in m.mine(df, 2 / len(baskets), 0.5).collect()}
    assert got == needed


def test_a_repeated_long_url_ends(spark):
    """Forty copies of a URL with thirty parameters among ordinary ones."""
    rows = [(i, f"http://a{i % 40}.example.org/{'es' if i % 3 else 'en'}/p{i % 7}?q={i}") for i in range(2000)]
    query = "&".join(f"{chr(97 + k % 26)}{'x' * (1 + k // 26)}=1" for k in range(30))
    rows += [(10_000 + i, f"http://shop.com/de/item?{query}") for i in range(40)]
    rows += [(20_000, "http://shop.net/item?dx=2"), (20_001, "http://b.net/?q=1")]
    got = {r["page_id"]: r["verdict"] for r in m.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[10_000] == "block" and got[20_000] == "block"
