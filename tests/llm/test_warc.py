from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import warc as m

ROWS = [
    (3, "http://a/", "same", "x"),
    (1, "http://b/\r\n%41", "same", "x"),
    (2, None, "same", "x"),
    (4, "http://c/ü", None, "x"),
    (5, "", "", "x"),
    (6, "http://d/", "é" * 70_000, "x"),
    (7, "http://e/", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "x"),
    (None, "http://f/", "alone", "x"),
    (None, "http://g/", "same", "x"),
    (8, "http://h/", "twice", "x"),
    (8, "http://h/", "twice", "x"),
]


@pytest.fixture
def archive(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, record_type string").repartition(3)
    path = (tmp_path / "archive").as_uri()
    m.write_warc(m.records(df), path)
    return path


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["record_id"], []).append(r)
    return out


def test_round_trip(spark, archive):
    got = by_id(m.read_warc(spark, archive))
    assert sum(map(len, got.values())) == len(ROWS)
    for i, url, html, _ in ROWS:
        raw = (html or "").encode()
        for r in (r for r in got[f"urn:page:{'' if i is None else i}"] if r["target_uri"] == url):
            assert r["payload_bytes"] == len(raw)
            assert r["payload_digest"] == "sha1:" + m.base32_sha1(raw)
            assert r["payload"] in (raw, None)
    kind = lambda i: [(r["record_type"], r["refers_to"]) for r in got[f"urn:page:{i}"]]
    assert kind(1) == kind(6) == kind(7) == [("response", None)]
    assert kind(2) == kind(3) == [("revisit", "urn:page:1")]
    assert kind(4) == [("response", None)] and kind(5) == [("revisit", "urn:page:4")]
    assert kind(8) == [("response", None)] * 2
    assert sorted(kind(""), key=str) == [("response", None), ("revisit", "urn:page:1")]


def test_filters_are_pushed_and_payloads_skipped(spark, archive, capsys):
    df = m.read_warc(spark, archive).where("record_type = 'revisit' and target_uri like 'http://%'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    assert {r["target_uri"] for r in df.collect()} == {"http://a/", "http://g/"}
    bare = m.read_warc(spark, archive, payload="false").collect()
    assert len(bare) == len(ROWS) and all(r["payload"] is None for r in bare)


def test_skipped_records_are_not_inflated(tmp_path):
    raw = m.record(1, "u", b"x" * 500_000, hashlib.sha1(b"").hexdigest(), 500_000, None)
    data = m.member(raw)
    assert gzip.decompress(data) == raw
    # A byte after the headers is broken: only reading the payload notices.
    broken = bytearray(data * 2)
    broken[len(data) - 40] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(broken)
    found = []
    with open(tmp_path / "a.warc.gz", "rb") as f:
        for headers, length, _ in m._records(m.Stream(f, 0, len(broken))):
            found.append((headers["warc-type"], length))
    assert len(found) == 2


def test_archives_of_other_tools(spark, tmp_path):
    records = [m.record(i, f"http://{i}/", b"p" * i * 3000, hashlib.sha1(b"p" * i * 3000).hexdigest(), i * 3000, None) for i in range(5)]
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "one" / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    rows = m.read_warc(spark, str(tmp_path / "one")).collect()
    assert sorted(len(r["payload"]) for r in rows) == sorted([i * 3000 for i in range(5)] * 2)
    only = m.read_warc(spark, str(tmp_path / "one")).where(F.col("record_id") == "urn:page:3").collect()
    assert len(only) == 2


def test_members_of_several_records(spark, tmp_path):
    records = [m.record(i, f"http://{i}/", b"p" * i * 30_000, hashlib.sha1(b"p" * i * 30_000).hexdigest(), i * 30_000, None) for i in range(6)]
    (tmp_path / "several").mkdir()
    (tmp_path / "several" / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "several" / "b.warc.gz").write_bytes(gzip.compress(b"".join(records[:4])) + gzip.compress(b"".join(records[4:])))
    rows = m.read_warc(spark, str(tmp_path / "several"))
    assert sorted(len(r["payload"]) for r in rows.collect()) == sorted([i * 30_000 for i in range(6)] * 2)
    assert rows.where(F.col("record_id") == "urn:page:5").count() == 2
    cut = gzip.compress(b"".join(records))[:-40]  # ends without the end of the member
    (tmp_path / "cut.warc.gz").write_bytes(cut)
    with open(tmp_path / "cut.warc.gz", "rb") as f:
        assert len(list(m._records(m.Stream(f, 0, len(cut))))) == 6


def test_splits_and_new_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "FILE_BYTES", 4000)
    monkeypatch.setattr(m, "SPLIT_BYTES", 900)
    writer = m.WarcWriter(str(tmp_path / "w"))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([
        {"page_id": i, "url": "u", "payload": bytes([i]) * 100, "sha1": hashlib.sha1(bytes([i]) * 100).hexdigest(), "payload_bytes": 100, "refers_to": None}
        for i in range(60)])
    messages = [writer.write(iter([batch]))]
    writer.commit(messages)
    reader = m.WarcReader(str(tmp_path / "w"), m.T.StructType.fromDDL(m.READ), True)
    parts = reader.partitions()
    assert len({p.path for p in parts}) > 1 and len(parts) > len({p.path for p in parts})
    ids = [r["record_id"] for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(ids) == sorted(f"urn:page:{i}" for i in range(60))
    writer.write(iter([batch]))  # of an attempt that was lost: not in the manifest
    assert len(reader.partitions()) == len(parts)


def test_wrong_digest(tmp_path):
    (tmp_path / "x.warc").write_bytes(m.record(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest(), 3, None))
    reader = m.WarcReader(str(tmp_path), None, True)
    with pytest.raises(ValueError, match="digest"), open(tmp_path / "x.warc", "rb") as f:
        [reader._row(*r) for r in m._records(m.Stream(f, 0, 10_000))]


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    m.write_warc(m.records(none), str(tmp_path / "none"))
    assert m.read_warc(spark, str(tmp_path / "none")).count() == 0


def test_least_bytes(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    rows = {r["page_id"]: r["refers_to"] for r in m.records(df, least=3).collect()}
    assert rows == {1: None, 2: None, 3: None, 4: 3}
