from __future__ import annotations

import zstandard
from pyspark.sql import functions as F

from ebbtide.llm import license_scan as m

# What stands in the test documents, by license.
LINES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "All rights reserved.": "all-rights-reserved",
}


def test_query_finds_the_lines(spark, sf_dir, documents):
    got = {r["doc_id"]: set(filter(None, r["licenses"].split(","))) for r in m.query(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    expected = {i: {l for line, l in LINES.items() if line in t.split("\n")} for i, t in texts.items()}
    assert sum(map(len, expected.values())) > 10
    assert got == expected


def test_every_template_is_its_own(spark):
    rows = [(i, f"Foo bar baz.\n{t}\nqux", name, 1) for i, (name, ts) in enumerate(m.TEMPLATES.items()) for t in ts]
    df = spark.createDataFrame(rows, "doc_id long, text string, notices string, n_blocks int")
    for r in m.scan(df).collect():
        assert [n["license"] for n in r["notices"]] == [r["doc"]["notices"]]
        assert not r["notices"][0]["missing"] and not r["notices"][0]["added"]


def test_wording_decides(spark):
    mit = m.TEMPLATES["MIT"][2]
    changed = mit.replace("Software", "Program", 2)
    other = "This license of permission is a long story about warranty and copyright and the law of the land"
    rows = [(0, changed), (1, other), (2, None), (3, ""), (4, mit.replace(". ", ".\n")), (5, "x " * 200_000 + "\n" + mit), (5, mit), (5, mit)]
    got = [(r["doc"], [(n["license"], len(n["missing"])) for n in r["notices"]]) for r in
           m.scan(spark.createDataFrame(rows, "doc_id long, text string"), row=F.col("doc_id")).collect()]
    found = {}
    for i, n in got:
        found.setdefault(i, []).append(n)
    assert found[0][0][0][0] == "MIT" and found[0][0][0][1] > 0
    assert found[1] == found[2] == found[3] == [[]]
    assert {n for notices in found[4] for n, _ in notices} == {"MIT"}
    assert len(found[5]) == 3 and all({n for n, _ in notices} == {"MIT"} for notices in found[5])


def test_ranking_is_by_bytes_saved():
    scanner = m.Scanner(m.TEMPLATES)
    notice = scanner.notice("Licensed under CC BY-NC 4.0.")
    assert notice.license == "CC-BY-NC-4.0" and notice.saved > 5


def test_empty_table(documents):
    assert m.scan(documents.limit(0)).count() == 0


def test_telling_words_decide():
    scanner = m.Scanner(m.TEMPLATES)
    for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause"):
        text = m.TEMPLATES[name][-1]
        for notice in (text, text.replace(". ", ".\n"), text.replace("program", "software")):
            assert {n.license for n in scanner.scan(notice)} == {name}
    lines = {"Licensed under CC BY-SA 3.0.": [], "Licensed under CC BY-NC-SA 4.0.": [], "Licensed under CC BY-ND 4.0.": [],
             "This work is licensed under the GNU Affero General Public License, version 2.": [],
             "This work is licensed under the GNU General Public License, version 2.0.": ["GPL-2.0"]}
    assert {line: [n.license for n in scanner.scan(line)] for line in lines} == lines
    gpl = m.TEMPLATES["GPL-3.0"][1]
    assert scanner.scan(gpl.replace("version 3", "version 4")) == []
    scanner = m.Scanner({"GPL-3.0": m.TEMPLATES["GPL-3.0"]})
    assert scanner.notice(m.TEMPLATES["GPL-2.0"][1]) is scanner.notice(m.TEMPLATES["LGPL-3.0"][0]) is None


def test_all_templates_are_compared():
    """Templates that save more bytes, but have the words in another order, hide none."""
    own = [f"permission{37 * i % 101}x{i}" for i in range(40)]
    near = {f"L{k}": (" ".join(own[20:] + own[:20] + [f"end{k}"]),) for k in range(5)}
    true = own.copy()
    true[10], true[30] = "some", "other"
    scanner = m.Scanner({"Z": (" ".join(true),)} | near)
    assert [n.license for n in scanner.notices(" ".join(own))] == ["Z"]


def common_words(a, b):
    """Length of the longest common run of words in order, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_ranking_against_plain_compression(documents):
    """Savings of every template computed apart, and the wording compared by the plain
    table of common words."""
    scanner = m.Scanner(m.TEMPLATES)
    blocks = {b for r in documents.collect() for b in scanner.blocks(r["text"])}
    blocks |= {" ".join(texts[0].split()[k : k + 40]) for texts in m.TEMPLATES.values() for k in (0, 5, 12)}
    told = 0
    for block in sorted(blocks):
        raw = block.lower().encode()
        saved = {}
        for name, texts in m.TEMPLATES.items():
            for text in texts:
                data = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packed = zstandard.ZstdCompressor(level=m.LEVEL, dict_data=data, write_content_size=False, write_dict_id=False).compress(raw)
                plain = zstandard.ZstdCompressor(level=m.LEVEL, write_content_size=False).compress(raw)
                saved.setdefault(name, []).append((len(plain) - len(packed), m.words(text)))
        found = [n for n, _ in scanner.candidates(block)]
        assert [(-n.saved, n.license) for n in found] == sorted((-n.saved, n.license) for n in found)
        own = m.words(block)
        for n in found:
            assert n.saved > 0
            matching = [words for bytes_, words in saved[n.license] if bytes_ == n.saved]
            assert matching, (n.license, n.saved, saved[n.license])
            # No alignment of the words leaves fewer added ones.
            assert len(n.added) >= min(len(own) - common_words(words, own) for words in matching)
            assert len(n.missing) + len(n.added) <= m.DIFFERENT * len(own)
        told += bool(found)
    assert told >= len(m.TEMPLATES)
