"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

Features: densities of a lexicon, nearness of its words to the second person, capitals,
punctuation and obfuscation. The lexicon is a short list of insults and what the labelled
texts add to it: words, and beginnings of words, that are far more frequent in toxic
texts. Lexicon, trees (Spark's ``GBTClassifier``) and calibration (Spark's
``IsotonicRegression``) learn from at most ``LABELLED`` labelled documents, chosen by a
hash of the id; documents with ``crc32(id) mod 5 = 0`` are never among them, and the fold
that calibrates is none that the trees have seen. Features are computed from whole texts
of all documents; ids, sources, languages and labels are no inputs of a score.

Defined results: null and empty texts have all features 0 and are scored like any text;
equal texts get equal scores; rows with a null id are scored and count as held out; labels
that are null or neither 0 nor 1 are left out, and of contradicting labels of an id 1
counts; without labels of both classes the score is 1 if all are toxic, else 0; an empty
table gives an empty table; further columns pass.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.shared import ROW, map_texts, staged, table, unpacked

LABELLED = 20_000
FOLDS, HELD_OUT, CALIBRATES = 5, 0, 4
TERMS = 4_000  # most mined terms
LEAST_TEXTS, LEAST_SHARE = 3, 0.004  # toxic texts that a mined term must occur in, and their share
LEAST_ODDS = 12.0
STEMS = (4, 5, 6)
WORDS_KEPT = 150_000
TIE = 0.01  # share of the uncalibrated score, which orders equal calibrated ones

# Common insults, and words for the second person.
INSULTS = """
bastard clown coward creep disgusting dumb fool freak garbage idiot imbecile jerk loser
lunatic moron parasite pathetic pig scum stupid trash ugly vermin worthless
""".split()
SECOND_PERSON = frozenset(
    """you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous
    votre vos usted ustedes ti tuyo vosotros""".split()
)
LEET = str.maketrans("013457@$!|+", "oieastasiit")
MARKS = string.punctuation

HIT, HIDDEN, SECOND, CAPS, SHAPE, SEED, SINGLE = (1 << i for i in range(7))
FEATURES = """seed_density lexicon_density lexicon_hits hidden_density second_person_nearness
capital_letters capital_words exclamations questions punctuation repeated_marks odd_shapes words""".split()


class Lexicon(dict):
    """Flags of whitespace-separated tokens, kept up to a number of entries. Terms that
    end in ``*`` are beginnings of words."""

    def __init__(self, terms) -> None:
        self.words = {t for t in terms if not t.endswith("*")}
        self.stems = {t[:-1] for t in terms if t.endswith("*")}
        self.seed = frozenset(INSULTS)

    def listed(self, word: str) -> bool:
        return word in self.words or word in self.seed or any(word[:k] in self.stems for k in STEMS)

    def __missing__(self, token: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        core = token.strip(MARKS)
        low, flags = core.lower(), 0
        if low.isalpha():
            flags |= HIT * self.listed(low) | SEED * (low in self.seed) | SECOND * (low in SECOND_PERSON)
            flags |= CAPS * (len(core) > 2 and core.isupper()) | SINGLE * (len(core) == 1)
        elif any(c.isalpha() for c in core) and any(not c.isalpha() and c not in "-'’" for c in core):
            plain = "".join(c for c in low.translate(LEET) if c.isalpha())
            flags |= SHAPE | HIDDEN * self.listed(plain)
        self[token] = flags
        return flags

    def features(self, raw: bytes | None) -> list[float]:
        """The values of ``FEATURES`` for a whole text."""
        text = raw.decode("utf-8", "replace") if raw else ""
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * len(FEATURES)
        flags = np.fromiter(map(self.__getitem__, words), np.int16, n)
        hidden = np.count_nonzero(flags & HIDDEN) + self._spelled(words, flags)
        hits = np.flatnonzero(flags & (HIT | HIDDEN))
        letters = len(raw) - len(raw.translate(None, string.ascii_letters.encode()))
        capitals = len(raw) - len(raw.translate(None, string.ascii_uppercase.encode()))
        marks = len(raw) - len(raw.translate(None, MARKS.encode()))
        return [
            np.count_nonzero(flags & SEED) / n,
            len(hits) / n,
            math.log1p(len(hits)),
            hidden / n,
            _nearness(hits, np.flatnonzero(flags & SECOND)),
            capitals / max(1, letters),
            np.count_nonzero(flags & CAPS) / n,
            text.count("!") / n,
            text.count("?") / n,
            marks / len(raw),
            (text.count("!!") + text.count("??") + text.count("***")) / n,
            np.count_nonzero(flags & SHAPE) / n,
            math.log1p(n),
        ]

    def _spelled(self, words: list[str], flags: np.ndarray) -> int:
        """Listed words spelled with spaces between the letters."""
        single = np.concatenate([[0], (flags & SINGLE) // SINGLE, [0]])
        edges = np.flatnonzero(np.diff(single))
        runs = [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= 4]
        return sum(self.listed("".join(w.strip(MARKS) for w in words[a:b]).lower()) for a, b in runs)


def _nearness(hits: np.ndarray, others: np.ndarray) -> float:
    """Mean over the hits of ``1 / (1 + distance / 5)`` to the nearest of ``others``."""
    if not len(hits) or not len(others):
        return 0.0
    at = np.searchsorted(others, hits)
    before = np.abs(hits - others[np.maximum(at - 1, 0)])
    after = np.abs(others[np.minimum(at, len(others) - 1)] - hits)
    return float(np.mean(1 / (1 + np.minimum(before, after) / 5)))


def terms(raw: bytes | None) -> set[str]:
    """The words of a text and their beginnings."""
    found = {w for w in (t.strip(MARKS).lower() for t in set((raw or b"").decode("utf-8", "replace").split())) if w.isalpha()}
    return found | {f"{w[:k]}*" for w in found for k in STEMS if len(w) >= k}


def mine_terms(labelled: DataFrame) -> list[str]:
    """Terms far more frequent among toxic texts, from rows ``(text binary, toxic)``."""

    def count(batches):
        counts = {0: Counter(), 1: Counter()}

        def flush():
            every = list(counts[0].keys() | counts[1].keys())
            cells = [every, [counts[1][t] for t in every], [counts[0][t] for t in every]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, (pa.string(), pa.int64(), pa.int64()), strict=True)],
                ["term", "toxic", "clean"],
            )

        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[toxic].update(terms(text))
                if len(counts[0]) + len(counts[1]) > WORDS_KEPT:
                    yield flush()
                    counts = {0: Counter(), 1: Counter()}
        yield flush()

    size = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * size.get(1, 0)))
    odds = (F.col("toxic") / size.get(1, 1)) / ((F.col("clean") + 0.5) / size.get(0, 1))
    summed = (
        labelled.select("text", "toxic")
        .mapInArrow(count, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= least) & (odds >= LEAST_ODDS))
        .orderBy(F.desc("toxic"), "term")
        .limit(TERMS)
    )
    return [r["term"] for r in summed.select("term").collect()]


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def training_set(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, distinct texts each."""
    own = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic"))
    chosen = (
        own.where("id is not null and toxic in (0, 1)")
        .where(fold(F.col("id")) != HELD_OUT)
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    # At most ``rows`` short rows are broadcast.
    found = texts.join(F.broadcast(chosen), "id")
    return found.groupBy(F.xxhash64("text").alias("hash"), (fold(F.col("id")) == CALIBRATES).alias("calibrates")).agg(
        F.min_by("text", "id").alias("text"), F.min_by("toxic", "id").alias("toxic")
    )


def with_features(docs: DataFrame, text: Column, lexicon: list[str], row: Column | None = None) -> DataFrame:
    def start():
        known = Lexicon(lexicon)
        return lambda texts: [[known.features(t) for t in texts]]

    return map_texts(docs, text, start, T.StructType.fromDDL("features array<double>"), row)


def fitted(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = LABELLED,
) -> Callable[..., DataFrame]:
    """Learns; returns ``score(docs, text, row=None)`` giving rows ``(doc, score)``."""
    known = staged(training_set(docs, labels, doc_id, text, label, rows), "labelled")
    learn = known.where("not calibrates")
    seen = {r["toxic"] for r in learn.select("toxic").distinct().collect()}
    if len(seen) < 2:
        constant = float(seen == {1})
        return lambda df, column="text", row=None: with_features(df, F.col(column), [], row).select(
            ROW, F.lit(constant).alias("score")
        )
    lexicon = mine_terms(learn)
    marks = F.struct("calibrates", F.col("toxic").cast("double").alias("label"))
    ready = staged(with_features(known, F.col("text"), lexicon, marks), "features")
    ready = ready.select("doc.*", array_to_vector("features").alias("features"))
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, seed=1).fit(ready.where("not calibrates"))

    def judged(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("raw", vector_to_array("probability")[1])

    held = judged(ready.where("calibrates")).select("raw", "label")
    curve = None if held.isEmpty() else IsotonicRegression(featuresCol="raw", predictionCol="even").fit(held)

    def score(df: DataFrame, column: str = "text", row: Column | None = None) -> DataFrame:
        made = with_features(df, F.col(column), lexicon, row).select(ROW, array_to_vector("features").alias("features"))
        made = judged(made)
        if curve is None:
            return made.select(ROW, F.col("raw").alias("score"))
        mixed = (1 - TIE) * F.col("even") + TIE * F.col("raw")
        return curve.transform(made).select(ROW, F.least(F.greatest(mixed, F.lit(0.0)), F.lit(1.0)).alias("score"))

    return score


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **columns) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns."""
    score = fitted(docs, labels, **columns)
    return unpacked(score(docs, columns.get("text", "text")).where(F.col("score") < threshold))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = fitted(docs, table(spark, sf_dir, "labels"))
    return score(docs, row=F.col("doc_id")).select(
        F.col(ROW).alias("doc_id"),
        F.coalesce(fold(F.col(ROW)) == HELD_OUT, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
