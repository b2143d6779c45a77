"""Language identification by Bayesian fusion of several kinds of evidence.

For every language ``l`` and for none of them (``und``), the log posterior of a row is

    log P(l | host) + text(l) + log P(declared | l) + log P(suffix | l).

* ``text``: log likelihood of the letter trigrams of the whole text, as a mean times the
  number of trigrams up to ``EVIDENCE``, since neighbouring trigrams aren't independent.
  Trigrams go to a fixed number of hash cells. The counts come from about ``SAMPLE``
  distinct labelled texts per language, chosen by hash; ``und`` spreads evenly. Every
  language with a label is modelled; beyond ``DENSE`` of them the table holds only the
  cells that occur in a language.
* ``P(l | host)``: shares of the text posteriors of the host's other rows, smoothed
  towards those of its domain, smoothed towards those of all rows. The sums are grouped
  aggregates over all rows; a row's own share is taken out of them.
* ``P(declared | l)``, ``P(suffix | l)``: the same sums by declared markup language and
  by the last label of the host, smoothed towards their share among all rows.

Sums combine on the map side, so a host with most rows is no larger group than another.
The host table is broadcast below a checked number of rows, else Spark joins by host.

Defined results: a text without letters has no text evidence and is not accepted; null
host, suffix or declared language give no such evidence, a declared language that isn't
known counts as one other value; without labelled texts every row is ``und``; ties go to
the language that sorts first; repeated rows are judged alike; an empty table gives an
empty table; further columns pass.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.shared import ROW, ascii_lower, map_texts, packed, staged, table, unpacked
from ebbtide.llm.url_rules import host_of

CELLS = 1 << 16
SAMPLE = 2_000
DENSE = 64  # most languages whose table has every cell
HELD = 1 << 20  # trigrams that a task counts at a time
EVIDENCE = 60
PSEUDO = 0.1  # added to every trigram count
HOST_WEIGHT, DOMAIN_WEIGHT, OTHER_WEIGHT = 4.0, 8.0, 20.0  # rows that smoothing stands for
BROADCAST_HOSTS = 100_000  # with up to DENSE languages, fewer with more
NONE = "und"

MARKUP = re.compile(rb"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&#?\w+;")
# Lower-case code of each letter, a space for anything else; codes beyond count as letters.
LETTER = np.array([ord(c.lower()[0]) if c.isalpha() else 32 for c in map(chr, range(0x3100))], np.uint32)


def cells(raw: bytes | None, markup: bool) -> np.ndarray:
    """Hash cells of the letter trigrams of a text, each with a letter in its middle."""
    if not raw:
        return np.empty(0, np.uint32)
    if markup:
        raw = MARKUP.sub(b" ", raw)
    codes = np.frombuffer((" " + raw.decode("utf-8", "replace") + " ").encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(codes < len(LETTER), LETTER[np.minimum(codes, len(LETTER) - 1)], codes)
    middle = codes[1:-1]
    key = codes[:-2] * np.uint32(0x9E3779B1) + middle * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    key = key[middle != 32]
    return (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)


@dataclass(frozen=True)
class Sparse:
    """A table of log likelihoods, of which most cells hold a column's lowest value."""

    lowest: np.ndarray  # by column
    start: np.ndarray  # of a cell in the next two
    column: np.ndarray
    above: np.ndarray  # what the cell has over the lowest value

    def total(self, found: np.ndarray) -> np.ndarray:
        """Sum of the rows of the cells found."""
        cell, times = np.unique(found, return_counts=True)
        size = self.start[cell + 1] - self.start[cell]
        at = np.arange(size.sum()) + np.repeat(self.start[cell] - (np.cumsum(size) - size), size)
        above = np.bincount(self.column[at], self.above[at] * np.repeat(times, size), len(self.lowest))
        return above + len(found) * self.lowest


@dataclass(frozen=True)
class TextModel:
    languages: list[str]  # sorted, without ``und``
    table: np.ndarray | Sparse  # log likelihood by cell and language, ``und`` last

    def evidence(self, raw: bytes | None, markup: bool) -> list[float]:
        found = cells(raw, markup)
        if not len(found):
            return [0.0] * (len(self.languages) + 1)
        if isinstance(self.table, Sparse):
            total = self.table.total(found.astype(np.int64))
        elif len(found) > CELLS:
            total = np.bincount(found, minlength=CELLS) @ self.table
        else:
            total = self.table[found].sum(axis=0)
        return (total / len(found) * min(len(found), EVIDENCE)).tolist()


def fit_text_model(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> TextModel:
    """From rows with a text and its language."""
    own = labelled.select(F.col(text).cast("binary").alias("text"), F.col(lang).alias("lang"))
    own = own.where("length(text) > 0 and lang is not null").withColumn("hash", F.xxhash64("text"))
    # Distinct texts, as the hash chooses among those: copies must not thin the sample.
    sizes = own.groupBy("lang").agg(F.count_distinct("hash").alias("n")).orderBy("lang").collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return TextModel([], np.full((CELLS, 1), -np.log(CELLS)))
    strides = {r["lang"]: max(1, r["n"] // sample) for r in sizes}
    every = F.element_at(_by_name({l: F.lit(k) for l, k in strides.items()}), F.col("lang"))
    chosen = own.where(F.pmod("hash", every) == 0).groupBy("lang", "hash").agg(F.first("text").alias("text"))
    place = {l: i for i, l in enumerate(languages)}

    def count(batches):
        held, size = [], 0

        def counted():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])

        for batch in batches:
            for l, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(cells(raw, False).astype(np.int64) + place[l] * CELLS)
                size += len(held[-1])
                if size >= HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    sums = chosen.select("lang", "text").mapInArrow(count, "key long, n long")
    sums = sums.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # a short row per cell that a language has
    return TextModel(languages, _table(sums.column("key").to_numpy(), sums.column("n").to_numpy(), len(languages)))


def _table(key: np.ndarray, n: np.ndarray, languages: int) -> np.ndarray | Sparse:
    """From the counts by ``language * CELLS + cell``; ``und`` is the last column."""
    column, cell = key // CELLS, key % CELLS
    total = np.bincount(column, n, languages) + PSEUDO * CELLS
    if languages <= DENSE:
        counts = np.zeros((CELLS, languages))
        counts[cell, column] = n
        return np.column_stack([np.log((counts + PSEUDO) / total), np.full(CELLS, -np.log(CELLS))])
    by = np.lexsort((column, cell))
    column, cell, n = column[by], cell[by], n[by]
    lowest = np.append(np.log(PSEUDO / total), -np.log(CELLS))
    start = np.searchsorted(cell, np.arange(CELLS + 1))
    return Sparse(lowest, start, column.astype(np.int32), np.log((n + PSEUDO) / PSEUDO))


def _by_name(values: dict[str, Column]) -> Column:
    """A constant map."""
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``; an inner function would evaluate ``value`` again for each element."""
    return F.transform(F.array(value), then)[0]


def _total(values: Column, start: float = 0.0) -> Column:
    return F.aggregate(values, F.lit(start), lambda a, x: a + x)


def _softmax(logs: Column) -> Column:
    powers = _let(logs, lambda own: _let(F.array_max(own), lambda top: F.transform(own, lambda x: F.exp(x - top))))
    return _let(powers, lambda own: _let(_total(own), lambda total: F.transform(own, lambda x: x / total)))


def _smoothed(sums: Column, towards: Column, weight: float) -> Column:
    """Shares of ``sums``, to which ``weight`` rows of the given shares are added."""
    shares = lambda own, size: F.zip_with(own, towards, lambda s, p: (s + weight * p) / size)
    return _let(sums, lambda own: _let(_total(own, weight), lambda size: shares(own, size)))


def suffix_of(host: Column) -> Column:
    """Last label of a host, null for an empty one."""
    return F.nullif(F.element_at(F.split(host, r"\."), -1), F.lit(""))


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def declared_in(html: Column) -> Column:
    """Primary language of the ``lang`` attribute of the html tag, else null."""
    found = F.regexp_extract(html, r"(?is)<html[^>]*?\slang\s*=\s*[\"']?([a-z]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def identify(
    df: DataFrame,
    model: TextModel,
    text: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    row: Column | None = None,
    markup: bool = False,
    least: float = 0.5,
) -> DataFrame:
    """Rows ``(doc, language, confidence, declared, accepted)``; ``doc`` holds the row's
    own columns, or ``row``. Accepted is a language, not ``und``, whose posterior is at
    least ``least`` and that the text itself speaks for."""
    spark = df.sparkSession
    names = [*model.languages, NONE]
    n = len(names)
    held = spark.sparkContext.broadcast(model)
    known = F.array(*[F.lit(x) for x in names])
    given = F.lit(None).cast("string") if declared is None else declared
    given = F.when(given.isNull() | F.array_contains(known, given), given).otherwise(F.lit("other"))
    own_host = F.lit(None).cast("string") if host is None else F.nullif(ascii_lower(host), F.lit(""))
    marks = F.struct(
        (packed(df) if row is None else row).alias(ROW),
        given.alias("declared"),
        own_host.alias("host"),
        F.coalesce(suffix_of(own_host), F.lit("")).alias("suffix"),
    )

    def start():
        return lambda texts: [[held.value.evidence(t, markup) for t in texts]]

    def read(columns: Column) -> DataFrame:
        made = map_texts(df, F.col(text), start, T.StructType.fromDDL("text array<double>"), columns)
        return made.withColumn("share", _softmax(F.col("text")))

    narrow = read(F.struct(*[marks[c].alias(c) for c in ("declared", "host", "suffix")]))
    sums = [F.sum(F.col("share")[i]).alias(f"s{i}") for i in range(n)]
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]
    array = F.array(*[F.col(f"s{i}") for i in range(n)])
    groups = staged(narrow.select("doc.*", "share").groupBy("host", "suffix", "declared").agg(*sums), "groups")

    total = np.array([x or 0.0 for x in groups.agg(*again).first()])
    overall = (total + 1) / (total.sum() + n)
    by_declared = {r["declared"]: np.array(r[1:]) for r in groups.where("declared is not null").groupBy("declared").agg(*again).collect()}
    hosts = groups.where("host is not null").groupBy("host", "suffix").agg(*again)
    domains = hosts.groupBy(domain_of(F.col("host")).alias("domain")).agg(*again).select("domain", array.alias("domain_sums"))
    suffixes = hosts.groupBy("suffix").agg(*again).select("suffix", array.alias("suffix_sums"))
    hosts = hosts.select("host", "suffix", domain_of(F.col("host")).alias("domain"), array.alias("host_sums"))
    hosts = staged(hosts.join(domains, "domain").join(suffixes, "suffix").drop("suffix", "domain"), "hosts")
    if hosts.count() * max(n, DENSE + 1) <= BROADCAST_HOSTS * (DENSE + 1):
        hosts = F.broadcast(hosts)

    rows = read(marks).select(f"{ROW}.*", "text", "share").join(hosts, "host", "left")
    numbers = lambda v: F.lit(np.asarray(v, np.float64))
    # Host prior: the other rows' shares, smoothed by those of the domain, by those of all.
    less = lambda sums: F.zip_with(sums, F.col("share"), lambda s, p: F.greatest(s - p, F.lit(0.0)))
    prior = numbers(overall)
    for level, weight in (("domain_sums", DOMAIN_WEIGHT), ("host_sums", HOST_WEIGHT)):
        prior = _smoothed(less(F.coalesce(F.col(level), F.col("share"))), prior, weight)
    logs = F.zip_with("text", prior, lambda t, p: t + F.log(p))
    # Suffix: its rows' shares by language against all rows of the language.
    part = _total(F.col("suffix_sums")) / F.lit(float(max(total.sum(), 1.0)))
    of_all = lambda p: F.zip_with("suffix_sums", numbers(total), lambda s, t: F.log((s + OTHER_WEIGHT * p) / (t + OTHER_WEIGHT)))
    suffix = _let(part, of_all)
    logs = F.zip_with(logs, F.coalesce(suffix, numbers([0.0] * n)), lambda a, b: a + b)
    # Declared language: the same, from a table of at most one row per language and one.
    said = sum(by_declared.values(), np.zeros(n))
    spoken = {}
    for value, own in by_declared.items():
        part_said = own.sum() / max(said.sum(), 1.0)
        spoken[value] = numbers(np.log((own + OTHER_WEIGHT * part_said) / (said + OTHER_WEIGHT)))
    spoken = F.element_at(_by_name(spoken), F.col("declared")) if spoken else F.lit(None)
    spoken = F.coalesce(spoken, numbers([0.0] * n))
    logs = F.zip_with(logs, spoken, lambda a, b: a + b)
    judged = rows.select(ROW, "declared", "text", _softmax(logs).alias("posterior"))
    best = F.array_max("posterior")
    speaks = F.exists("text", lambda x: x != 0)
    return judged.select(
        ROW,
        F.element_at(known, F.array_position("posterior", best).cast("int")).alias("language"),
        best.alias("confidence"),
        "declared",
        (speaks & (F.array_position("posterior", best) < n) & (best >= least)).alias("accepted"),
    )


def with_known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is accepted, with their own columns; the declared
    language is ``lang``, the host is ``source``."""
    model = fit_text_model(docs)
    found = identify(docs, model, declared=F.lower("lang"), host=F.col("source"), least=least)
    return unpacked(found.where("accepted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_text_model(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages")
    found = identify(
        pages, model, text="html", declared=declared_in(F.col("html")), host=host_of(F.col("url")),
        row=F.col("page_id"), markup=True,
    )
    return found.select(F.col(ROW).alias("page_id"), "language", F.round("confidence", 6).alias("confidence"), "declared", "accepted")
