"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams.

Words are the runs of ASCII letters and digits and of all characters beyond ASCII, with
A-Z lower-cased. A window is 13 consecutive words of an item; an item of fewer words is
one window. Each task turns a document into numbers of benchmark words, hashes only the
windows made of such words, looks them up and verifies each hit word by word.

The benchmark is broadcast in blocks of bounded size. One block serves any usual
benchmark; beyond that the documents pass the blocks one after another, through the
shared folder, and each block adds its hits to those found before.

Defined results: a null or empty text or one without words has no hits and isn't
contaminated; an item without words has no window; equal items hit alike; repeated rows
are judged each for itself; an empty benchmark hits nothing; further columns pass.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ebbtide.llm.shared import ROW, packed, small_batches, staged, table, unpacked

WINDOW = 13
BLOCK_BYTES = 32 << 20
CHUNK = 1 << 16

LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(LOWER).split() if text else []


class Windows:
    """The windows of some items, keyed by the numbers of their words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.number: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            numbers = np.array([self.number.setdefault(w, len(self.number)) for w in words(text)], np.int32)
            length = min(window, len(numbers))
            for i in range(len(numbers) - length + 1 if length else 0):
                self.items[length][numbers[i : i + length].tobytes()].add(item)
        self.hashes = {
            n: np.unique(_hashes(np.stack([np.frombuffer(k, np.int32) for k in keys])))
            for n, keys in self.items.items()
        }

    def hits(self, text: bytes | None, before: bytes | None = None) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items that occur."""
        found = words(text)
        numbers = np.fromiter(map(self.number.get, found, repeat(-1)), np.int32, len(found))
        inside = np.zeros(len(found), bool)
        if before:
            inside |= np.unpackbits(np.frombuffer(before, np.uint8), count=len(found)).astype(bool)
        known = np.concatenate([[0], np.cumsum(numbers >= 0)])
        items: set[str] = set()
        for length, table in self.items.items():
            if len(found) < length:
                continue
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            view = np.lib.stride_tricks.sliding_window_view(numbers, length)
            for k in range(0, len(starts), CHUNK):
                part = starts[k : k + CHUNK]
                for i in part[np.isin(_hashes(view[part]), self.hashes[length])].tolist():
                    if owners := table.get(numbers[i : i + length].tobytes()):
                        inside[i : i + length] = True
                        items |= owners
        return inside, items


def _hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of word numbers, modulo 2**64."""
    powers = np.ones(rows.shape[1], np.uint64)
    with np.errstate(over="ignore"):
        for i in range(1, len(powers)):
            powers[i] = powers[i - 1] * np.uint64(0x9E3779B97F4A7C15)
        return (rows.astype(np.uint64) + np.uint64(1)) @ powers


def _spans(inside: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items in blocks of about ``block_bytes``, one block at a time."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text")
    ).where("item is not null and length(text) > 0")
    total = items.agg(F.coalesce(F.sum(F.length("text") + F.lit(64)), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k) if n > 1 else items
        yield k == n - 1, [(r["item"], bytes(r["text"])) for r in block.toLocalIterator()]


RESULT = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>"


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    row: Column | None = None,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows ``(doc, n_words, n_hit, items, spans)``: ``doc`` holds the row's own columns
    (or ``row``), ``items`` the ids of occurring items as sorted text, ``spans`` the
    half-open ranges of hit words."""
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    frame = docs.select(
        (packed(docs) if row is None else row).alias(ROW),
        F.col(text).cast("binary").alias("text"),
        F.lit(None).cast("binary").alias("hit"),
        F.array().cast("array<string>").alias("items"),
    )
    own = frame.schema[ROW]
    result = T.StructType.fromDDL(RESULT)
    for last, items in _blocks(benchmark, item_id, item_text, block_bytes):
        held = context.broadcast(items)
        carried = [] if last else frame.schema.fields[1:3]
        schema = T.StructType([own, *carried, frame.schema["items"], *result])
        frame = frame.select(ROW, "text", "hit", "items").mapInArrow(_scan_with(held, window, schema, last), schema)
        if not last:
            frame = staged(frame, "block")
    return frame.select(ROW, "n_words", "n_hit", "items", "spans")


def _scan_with(held, window: int, schema: T.StructType, last: bool):
    kinds = {f.name: to_arrow_type(f.dataType) for f in schema if f.name not in (ROW, "text")}

    def run(batches):
        index = Windows(held.value, window)
        for batch in batches:
            out = {name: [] for name in kinds}
            cells = zip(*(batch.column(c).to_pylist() for c in ("text", "hit", "items")), strict=True)
            for text, before, items in cells:
                inside, owners = index.hits(text, before)
                spans = _spans(inside)
                hit = {
                    "hit": np.packbits(inside).tobytes() if spans and not last else None,
                    "items": sorted(owners.union(items)),
                    "n_words": len(inside),
                    "n_hit": sum(b - a for a, b in spans),
                    "spans": [{"start": a, "end": b} for a, b in spans],
                }
                for name, cell in out.items():
                    cell.append(hit[name])
            made = {name: pa.array(v, kinds[name]) for name, v in out.items()}
            passed = {name: batch.column(name) for name in (ROW, "text")}
            yield pa.RecordBatch.from_pydict({f.name: (made | passed)[f.name] for f in schema})

    return run


def contaminated(n_words: Column, n_hit: Column, share: float = 0.05) -> Column:
    """At least ``share`` of the words are hit; whole numbers, so no rounding decides."""
    return (n_hit > 0) & (n_hit * 10_000 >= n_words * round(share * 10_000))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.05, **options) -> DataFrame:
    """The documents that aren't contaminated, with their own columns."""
    scanned = scan(docs, benchmark, **options)
    return unpacked(scanned.where(~contaminated(F.col("n_words"), F.col("n_hit"), share)))


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, hit words and what stands between them cut out of the text."""
    scanned = scan(docs, benchmark, text=text, **options)
    whole = T.StructType([T.StructField("cut", T.StringType())])
    spans = F.transform("spans", lambda s: F.struct(s["start"], s["end"]))
    packed_row = scanned.select(F.struct(ROW, spans.alias("spans")).alias(ROW), F.col(f"{ROW}.{text}").alias("text"))
    kinds = T.StructType([packed_row.schema[ROW], *whole])

    def run(batches):
        for batch in batches:
            ranges = batch.column(ROW).field("spans").to_pylist()
            cut = [_cut(t, s) for t, s in zip(batch.column("text").to_pylist(), ranges, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(cut, pa.string())], [ROW, "cut"])

    done = packed_row.mapInArrow(run, kinds)
    names = done.schema[ROW].dataType[ROW].dataType.names
    return done.select(*[(F.col("cut") if c == text else F.col(ROW)[ROW][c]).alias(c) for c in names])


def _cut(text: str | None, spans: list[dict] | None) -> str | None:
    if text is None or not spans:
        return text
    raw = text.encode()
    at = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", raw.translate(LOWER))]
    kept, end = [], 0
    for s in (list(x.values()) for x in spans):
        kept.append(raw[end : at[s[0]][0]])
        end = at[s[1] - 1][1]
    return b"".join([*kept, raw[end:]]).decode()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, table(spark, sf_dir, "benchmark"), row=F.col("doc_id"))
    return found.select(
        F.col(ROW).alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
sized AS (SELECT item, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM sized, unnest(range(1, len(w) - n + 2)) AS r(i)),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM docs, (SELECT DISTINCT n FROM win) AS l, unnest(range(1, len(w) - n + 2)) AS r(i)),
hit AS (SELECT p.doc_id, p.n, p.i, win.item FROM place p JOIN win ON p.n = win.n AND p.gram = win.gram),
hit_word AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(j) GROUP BY doc_id),
hit_item AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_word USING (doc_id) LEFT JOIN hit_item USING (doc_id)
"""
