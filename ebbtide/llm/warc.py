"""WARC archives as a Spark data source, ``spark.read.format("warc")``.

Writing: each task writes its records to files of its own, one gzip member per record,
and rolls over to a new file at a size limit. A member names its own length in the extra
field ``sl``. The driver's commit lists the files of the successful attempts, with the
offsets where a reader may start, in a manifest; files of lost attempts aren't listed.

Reading: partitions are ranges of files, planned from the manifest, or whole files where
there is none. A task inflates the headers of a record first, tests the pushed filters on
record type and other header columns, and only then the payload; the rest of an unwanted
record is skipped by its length. Archives of other tools, compressed or not, are read too.

Records of equal payloads: that of the smallest page_id is a ``response``, the others
are ``revisit`` records that refer to it and have no payload of their own.

Defined results: a null html is an empty payload; a null url gives no target URI; rows
that repeat a page_id and its payload are responses each; rows without page_id revisit
any other row of equal payload; control characters and ``%`` in a URL are percent-encoded in the header and
decoded when read; a payload that doesn't match its digest ends the read; an empty table
gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from ebbtide.llm.shared import shared_path, small_batches, table

FILE_BYTES = 256 << 20  # a new file after so much
SPLIT_BYTES = 32 << 20  # at least between two offsets where a reader may start
BATCH_BYTES = 8 << 20
MANIFEST = "_manifest.json"
ID = "urn:page:"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITTEN = "page_id long, url string, payload binary, sha1 string, payload_bytes long, refers_to long"
READ = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, payload_bytes long, payload binary"
)
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, of any store that Arrow knows."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _quoted(url: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload, sha1: str, payload_bytes: int, refers_to) -> bytes:
    """The bytes of one record; ``payload`` is left out of a revisit."""
    name = lambda i: f"<{ID}{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _quoted(url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
        "WARC-Refers-To": None if refers_to is None else name(refers_to),
        "WARC-Profile": None if refers_to is None else PROFILE,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member that names its lengths in the extra field ``sl``."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(raw) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


@dataclass
class Files(WriterCommitMessage):
    files: list[dict]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        files, out, last = [], None, None
        for batch in iterator:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or last["bytes"] >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    last = {"name": f"part-{uuid.uuid4().hex}.warc.gz", "bytes": 0, "starts": [0]}
                    files.append(last)
                    out = store.open_output_stream(f"{folder}/{last['name']}", compression=None)
                if last["bytes"] - last["starts"][-1] >= SPLIT_BYTES:
                    last["starts"].append(last["bytes"])
                raw = member(record(*row))
                out.write(raw)
                last["bytes"] += len(raw)
        if out is not None:
            out.close()
        return Files(files)

    def commit(self, messages) -> None:
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        listed = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        store, folder = opened(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                store.delete_file(f"{folder}/{f['name']}")


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class Stream:
    """Bytes of a file with a window to look ahead in."""

    def __init__(self, file, start: int, end: int, piece: int = 1 << 20) -> None:
        self.file, self.at, self.end, self.piece = file, start, end, piece
        self.held, self.from_ = b"", start

    def ahead(self, n: int) -> bytes:
        """At least ``n`` bytes from the present place, fewer only at the end."""
        have = self.from_ + len(self.held) - self.at
        if self.at < self.from_ or have < n:
            self.file.seek(self.at)
            self.from_ = self.at
            self.held = self.file.read(max(0, min(max(n, self.piece), self.end - self.at)))
        return self.held[self.at - self.from_ :]


def _records(stream: Stream):
    """Headers and a function for the block of each record, which is inflated on call."""
    while start := stream.ahead(24)[:24]:
        if start[:2] == b"\x1f\x8b":
            known = start[3] == 4 and start[12:14] == b"sl"
            size = struct.unpack("<I", start[16:20])[0] if known else 0
            place = stream.at
            yield from _member(stream, size)
            if known:
                stream.at = place + size
        elif start.strip(b"\r\n"):
            yield _plain(stream)
        else:
            stream.at += len(start)


def _member(stream: Stream, size: int):
    inflate, raw, at = zlib.decompressobj(31), b"", stream.at

    def more(n: int) -> bool:
        nonlocal raw, at
        if inflate.eof:
            return False
        got = inflate.decompress(inflate.unconsumed_tail, n)  # what is left of earlier input
        if not got and not inflate.eof:
            stream.at = at
            feed = stream.ahead(min(size, 1 << 16) if size else 1 << 16)[: 1 << 16]
            if not feed:
                return False
            at += len(feed)
            got = inflate.decompress(inflate.unconsumed_tail + feed, n)
        raw += got
        return not inflate.eof

    def drop(n: int) -> None:
        """Pass over bytes and the line breaks behind them."""
        nonlocal raw
        while n > len(raw):
            n, raw = n - len(raw), b""
            if not more(1 << 16) and not raw:
                return
        raw = raw[n:]
        while not (raw := raw.lstrip(b"\r\n")):
            if not more(4096) and not raw:
                return

    while True:
        while b"\r\n\r\n" not in raw and more(4096):
            pass
        headers, begin = _headers(raw)
        length = int(headers.get("content-length", 0))

        def block(need: int | None = None, begin: int = begin, length: int = length) -> bytes:
            until = begin + (length if need is None else min(need, length))
            while len(raw) < until and more(max(4096, until - len(raw))):
                pass
            return raw[begin:until]

        yield headers, length, block
        if size:
            return
        # No length: other tools may put several records into a member, whose end must be
        # found by inflating.
        drop(begin + length)
        if not raw:
            break
    stream.at = at - len(inflate.unused_data)


def _plain(stream: Stream):
    n = 4096
    while b"\r\n\r\n" not in (raw := stream.ahead(n)) and len(raw) >= n:
        n *= 2
    headers, begin = _headers(raw)
    length, place = int(headers.get("content-length", 0)), stream.at + begin
    stream.at = place + length + 4

    def block(need: int | None = None) -> bytes:
        other = Stream(stream.file, place, stream.end)
        wanted = length if need is None else min(need, length)
        return other.ahead(wanted)[:wanted]

    return headers, length, block


def _headers(raw: bytes) -> tuple[dict[str, str], int]:
    end = raw.find(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")
    fields = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}, end + 4


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, payload: bool) -> None:
        self.path, self.schema, self.payload = path, schema, payload
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)) else None
            if column in HEADER_OF and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, folder = opened(self.path)
        if store.get_file_info(f"{folder}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_file(f"{folder}/{MANIFEST}") as listed:
                files = json.loads(listed.read())
        else:
            found = store.get_file_info(pafs.FileSelector(folder, recursive=True))
            files = [
                {"name": f.path.removeprefix(folder).lstrip("/"), "bytes": f.size, "starts": [0]}
                for f in found
                if f.path.endswith((".warc", ".warc.gz"))
            ]
        return [
            Range(f"{folder}/{f['name']}", start, end)
            for f in files
            for start, end in zip(f["starts"], [*f["starts"][1:], f["bytes"]], strict=True)
        ] or [Range("", 0, 0)]

    def wanted(self, values: dict) -> bool:
        tests = {
            EqualTo: lambda f, v: v == f.value,
            In: lambda f, v: v in f.value,
            IsNotNull: lambda f, v: True,
            StringStartsWith: lambda f, v: v.startswith(f.value),
        }
        return all(
            (v := values[f.attribute[0]]) is not None and tests[type(f)](f, v) for f in self.filters
        )

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        arrow, rows, held = to_arrow_schema(self.schema), [], 0
        if partition.path:
            store, _ = opened(self.path)
            with store.open_input_file(partition.path) as file:
                for headers, length, block in _records(Stream(file, partition.start, partition.end)):
                    row = self._row(headers, length, block)
                    if row is not None:
                        rows.append(row)
                        held += 500 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    def _row(self, headers: dict[str, str], length: int, block) -> dict | None:
        row = {column: headers.get(name) for column, name in HEADER_OF.items()}
        for column in ("record_id", "refers_to"):
            row[column] = row[column].strip("<>") if row[column] else None
        row["target_uri"] = unquote(row["target_uri"]) if row["target_uri"] else row["target_uri"]
        if not self.wanted(row):
            return None
        head, http = b"", headers.get("content-type", "").startswith("application/http")
        n = 1024
        while http and b"\r\n\r\n" not in (head := block(n)) and n < length:
            n *= 2
        fields, begin = _headers(head) if b"\r\n\r\n" in head else ({}, 0)
        row["payload_bytes"] = int(fields.get("content-length", length - begin))
        row["payload"] = None
        if self.payload and row["record_type"] != "revisit":
            row["payload"] = block()[begin:]
            row["payload_bytes"] = len(row["payload"])
            digest = row["payload_digest"] or ""
            if digest.startswith("sha1:") and digest[5:] != base32_sha1(row["payload"]):
                raise ValueError(f"payload of {row['record_id']} doesn't match its digest")
        return row


class WarcDataSource(DataSource):
    """Options: ``path``; ``payload=false`` leaves all payloads undecoded and null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, self.options.get("payload", "true").lower() != "false")

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if schema.names != [c.split()[0] for c in WRITTEN.split(", ")]:
            raise ValueError(f"rows to write are {WRITTEN}")
        return WarcWriter(self.options["path"])


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Rows to write; payloads of fewer than ``least`` bytes are always responses."""
    own = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    equal = ["sha1", "payload_bytes"]
    first = own.where(F.col("payload_bytes") >= least).groupBy(*equal).agg(F.min("page_id").alias("first"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    done = own.join(first, equal, "left").withColumn("refers_to", F.when(again, F.col("first")))
    names = [c.split()[0] for c in WRITTEN.split(", ")]
    # A revisit has no payload, so only those of responses go to the writer.
    return done.withColumn("payload", F.when(~again | F.col("first").isNull(), F.col("payload"))).select(*names)


def write_warc(df: DataFrame, path: str) -> None:
    small_batches(df.sparkSession)
    df.sparkSession.dataSource.register(WarcDataSource)
    df.write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(records(table(spark, sf_dir, "pages")), path)
    number = lambda c: F.substring(c, len(ID) + 1, 20).try_cast("long")
    return read_warc(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.substring("payload_digest", 6, 32).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


SQL = """
WITH own AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM own),
bits AS (
  SELECT *, array_to_string(list_transform(range(0, 40), lambda i:
    lpad(bin(CAST('0x' || hex[i + 1] AS INTEGER)), 4, '0')), '') AS b FROM hashed),
digest AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(b[5 * i + j + 1] AS INTEGER) * (16 >> j))) AS INTEGER), 1)), '')
    AS payload_digest, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM bits)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digest
"""
