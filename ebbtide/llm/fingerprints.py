"""Document fingerprints: every shingle hash below a fixed fraction of all hashes.

A text's shingles are its distinct runs of five words (A-Z lower-cased, words end at
white space); fewer words are one shingle, no word none. Of their 64-bit hashes the
fingerprint keeps all below ``2**64 / FRACTION``: whether a hash is kept depends on the hash
alone, so the fingerprint of a union is the union of fingerprints, and the share of one
fingerprint found in another estimates containment however unequal the two texts are. A
text with less than ``LEAST`` such hashes keeps its ``LEAST`` smallest ones instead (all, if
it has no more), so that short texts are told apart too. A fingerprint therefore starts
with its reach: every hash up to the reach is in it. Two are compared, and merged, up to the
smaller reach; the result is that of the whole sets.

As a string a fingerprint is the Base64 form of big-endian 64-bit numbers, first the reach,
then the kept hashes in rising order.

Defined results: null is the empty text, whose fingerprint has no hash; bytes that are no
UTF-8 become U+FFFD; equal texts have equal fingerprints, and equal fingerprints are alike
by 1; a fingerprint without hashes below the common reach is alike to no other one;
repeated rows, empty tables and further columns pass.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from ebbtide.llm.ngram_join import Words, tokens
from ebbtide.llm.shared import map_texts, small_batches, table, unpacked

FRACTION = 8
LEAST = 32
ALL = np.uint64(2**64 - 1)
BELOW = np.uint64(2**64 // FRACTION - 1)  # the last hash below the fraction

Sketch = tuple[np.uint64, np.ndarray]  # reach, kept hashes in rising order


def kept(hashes: np.ndarray, reach: np.uint64 = ALL) -> Sketch:
    """The sketch of sorted distinct hashes that are complete up to ``reach``."""
    below = int(np.searchsorted(hashes, BELOW, "right"))
    if below >= LEAST:
        return BELOW, hashes[:below]
    if len(hashes) > LEAST:
        return hashes[LEAST - 1], hashes[:LEAST]
    return reach, hashes


def sketch(text: str, words: Words) -> Sketch:
    return kept(tokens(text.encode("utf-8", "replace"), words))


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of both texts' shingles together."""
    reach = min(a[0], b[0])
    both = np.union1d(a[1], b[1])
    return kept(both[: np.searchsorted(both, reach, "right")], reach)


def likeness(a: Sketch, b: Sketch) -> tuple[float, float]:
    """Estimated share of the shingles of ``a`` that ``b`` has, and Jaccard similarity."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0, 1.0
    reach = min(a[0], b[0])
    x, y = (s[1][: np.searchsorted(s[1], reach, "right")] for s in (a, b))
    if not len(x) or not len(y):
        return 0.0, 0.0
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / len(x), common / (len(x) + len(y) - common)


def packed_sketch(s: Sketch) -> str:
    return base64.b64encode(np.concatenate([[s[0]], s[1]]).astype(">u8").tobytes()).decode()


def unpacked_sketch(text: str) -> Sketch:
    numbers = np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)
    return numbers[0], numbers[1:]


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each whole text."""

    def start():
        words = Words()
        return lambda texts: [[packed_sketch(sketch(decoded(t), words)) for t in texts]]

    field = T.StructType([T.StructField(out, T.StringType())])
    return unpacked(map_texts(df, F.col(text), start, field), out)


def decoded(raw: bytes | None) -> str:
    return raw.decode("utf-8", "replace") if raw else ""


def contained(a: str | Column, b: str | Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, of two fingerprint
    columns; null if one is null."""

    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        pairs = zip(x, y, strict=True)
        return pd.Series([None if p is None or q is None else likeness(unpacked_sketch(p), unpacked_sketch(q))[0] for p, q in pairs], dtype="float64")

    return share(a, b)


def merged(df: DataFrame, by: list[str], fingerprint: str = "fingerprint") -> DataFrame:
    """Rows ``(*by, hash)``: the union of the fingerprints of each group, one row a hash, as
    a group of many documents has no bounded fingerprint. Hashes are those below the
    fraction; duplicates go before the shuffle. Two groups' containment is a join by hash."""

    @F.pandas_udf("array<long>")
    def hashes(column: pd.Series) -> pd.Series:
        found = (None if x is None else unpacked_sketch(x)[1] for x in column)
        return pd.Series([None if h is None else h[: np.searchsorted(h, BELOW, "right")].astype(np.int64) for h in found])

    return df.select(*by, F.explode(hashes(F.col(fingerprint))).alias("hash")).distinct()


def in_order(df: DataFrame, key: str, run, schema: T.StructType) -> DataFrame:
    """Apply ``run(batches)`` to the rows ``(key, text, extra)`` of parts of the table, each
    part in rising order of key and text, followed by an extra row: the one that comes after
    the part, which for the last part is the first row of all.

    The parts are cut at quantiles of the key, so one shuffle deals the texts out; apart from
    the cuts and the first key of each part nothing goes through the driver. Rows without key
    are left out.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col("text").cast("binary").alias("text")).where("key is not null")
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("key", shares or [0.5], 20 * parts)).first()[0] or []
    cuts = np.unique(np.array(found if shares else [], np.int64))

    def part_of(column: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, column.to_numpy(), "right").astype(np.int32))

    part = F.pandas_udf(part_of, "int")
    firsts = rows.groupBy(part("key").alias("part")).agg(F.min("key").alias("key")).toArrow().sort_by("part")
    numbers, keys = firsts.column("part").to_pylist(), firsts.column("key").to_pylist()
    before = dict(zip(keys, [*numbers[-1:], *numbers[:-1]], strict=True))

    @F.pandas_udf("array<struct<part:int,extra:boolean>>")
    def places(column: pd.Series) -> pd.Series:
        own = part_of(column)
        return pd.Series(
            [[(p, False)] + ([(before[k], True)] if k in before else []) for k, p in zip(column.tolist(), own.tolist(), strict=True)]
        )

    dealt = rows.select("key", "text", F.explode(places("key")).alias("at")).select("key", "text", "at.*")
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "extra", "key", "text")
    small_batches(spark)
    return dealt.select("key", "text", "extra").mapInArrow(run, schema)


NUMBER, NAME, SHARE = pa.int64(), pa.string(), pa.float64()
EDITED = pa.schema(
    {
        "doc_id": NUMBER,
        "n_chars": NUMBER,
        "edited_sha256": NAME,
        "fingerprint": NAME,
        "edited_fingerprint": NAME,
        "near_edited": SHARE,
        "near_next": SHARE,
        "jaccard_edited": SHARE,
        "jaccard_next": SHARE,
    }
)


def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order, every row but the extra ones with the edit made from its successor."""
    words, last = Words(), None
    for batch in batches:
        out = []
        for key, raw, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if extra and last is None:  # of several rows that share the key of the extra one
                continue
            text = decoded(raw)
            this = key, text, sketch(text, words)
            if last is not None:
                out.append(edited_row(words, *last, *this[1:]))
            last = None if extra else this
        if out:
            cells = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), EDITED.types, strict=True)]
            yield pa.RecordBatch.from_arrays(cells, EDITED.names)


def edited_row(words: Words, key: int, text: str, own: Sketch, following: str, after: Sketch) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    other = own if edited == text else sketch(edited, words)
    near, next_ = likeness(own, other), likeness(own, after)
    name = hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest()
    return key, len(text), name, packed_sketch(own), packed_sketch(other), near[0], next_[0], near[1], next_[1]


def edited_fingerprints(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Fingerprints of each text and of its edited form, whose second half (rounded down) is
    replaced by as many code points from the start of the next text, and how much of the
    fingerprint is found in that of the edited and of the next text. Rows of one key follow
    one another by text; a row without key has no place in the order and is left out."""
    return in_order(df, key, edits, from_arrow_schema(EDITED))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
