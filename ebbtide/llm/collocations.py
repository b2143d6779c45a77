"""Phrase collocations per language by best-first growth of prefixes.

Texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at spaces and tabs into words,
A-Z lower-cased. A phrase of two or three words that occurs ``LEAST`` times or more is a
candidate. Cut after its first k words, with l and r the counts of the two parts, it
scores ``floor(10^6 a^2 / (l r))``; its lowest cut counts. A candidate inside a longer one
that occurs at least half as often is dropped, and each language's best 2000 remain.

Words and pairs are counted in full, each level only where the words before are frequent.
Growing a pair to three words is what costs, so it is done best first. As a phrase occurs
no more often than its parts, ``xyz`` occurs at most ``m = min(f(xy), max f(y.))`` times and
scores at most ``10^6 m / f(x)``: an admissible bound for everything that the prefix
``xy`` can grow to. A round lowers a language's threshold to the score that so many
of its candidates reach and

* grows every prefix whose bound reaches the threshold, and
* counts the longer phrases that end in a pair whose own score reaches it or that start
  with it, where they could be frequent enough to drop the pair.

Then every candidate at or above the threshold is known and known to stay or go. A language
is settled once 2000 of them stay, which includes all ties of the last one, or once nothing
is left to grow; else the next round asks for twice as many.

What a round grows is told to the tasks by bitmaps of fixed size. A pair that hits a bit by
chance only has its longer phrases counted needlessly; every count that is made is of all
occurrences, so it is exact. Tasks count in arrays and send each distinct phrase once a
flush. Thresholds are found from counts per score, of which a language has at most a
million and one, and the best are taken in salted groups first.

Defined results: a null text is empty; a null language is ``und``, an empty one stays
empty; bytes that are no UTF-8 become U+FFFD; scores are exact in decimals while counts
are below 10^16; repeated rows count as often as they occur; a language without
candidates has no rows, nor has an empty table; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import finished, small_batches, staged, table

LEAST = 10
TOP = 2000
SHARE = 50  # percent of a candidate's count at which a longer one drops it
FIRST = 2  # candidates that the first round asks for, in multiples of the wanted rows
MILLION = 1_000_000

FLUSH = 1_500_000  # words that a task counts at a time
SLICE = 1 << 20  # bytes of a text that are split at a time; with FLUSH below 2**21 words
ROWS = 1 << 16
BITS = 25  # of a bitmap's positions: 4 MB

END = b"\xff"  # a piece ends here; no byte of UTF-8
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
COUNTS = ["lang", "phrase", "c"]


class Numbers(dict):
    """Numbers of words in the order of their first occurrence; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text and the ends of its pieces, in slices of bounded size."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "replace").encode()
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + SLICE)
        stop = len(raw) if stop < 0 else stop
        yield raw[start:stop].translate(FOLDED).replace(b"\n", b" \xff ").split()
        start = stop
    yield [END]


class Counter:
    """Counts the phrases of ``size`` words, flush by flush."""

    def __init__(self, size: int, maps: list[np.ndarray]) -> None:
        self.size, self.maps = size, maps
        self.clear()

    def clear(self) -> None:
        self.numbers, self.runs, self.total = Numbers(), {}, 0

    def add(self, lang: str, raw: bytes) -> Iterator[pa.RecordBatch]:
        for words in words_of(raw):
            run = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            self.runs.setdefault(lang, []).append(run)
            self.total += len(words)
            if self.total >= FLUSH:
                # Phrases that go on in the next slice start with the last words so far.
                so_far, names = np.concatenate(self.runs[lang]), list(self.numbers)
                last = so_far[max(0, len(so_far) - self.size + 1) :].tolist()
                yield from self.flush()
                self.runs[lang] = [np.array([self.numbers[names[i]] for i in last], np.int64)]

    def flush(self) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(self.numbers), pa.binary())
        for lang, runs in self.runs.items():
            run = np.concatenate(runs)
            runs.clear()
            seed = xxhash.xxh64_intdigest(lang.encode(), 42)
            numbers, count = getattr(self, f"_of_{self.size}")(run, words, seed)
            for at in range(0, len(count), ROWS):
                parts = [words.take(pa.array(n[at : at + ROWS])) for n in numbers]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                cells = [pa.array([lang] * len(phrase), pa.string()), phrase, pa.array(count[at : at + ROWS], pa.int64())]
                yield pa.RecordBatch.from_arrays(cells, COUNTS)
            if self.size == 1:
                total = [pa.array([v], k) for v, k in ((lang, pa.string()), (b"", pa.binary()), (count.sum(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(total, COUNTS)
        self.clear()

    def _hashes(self, run: np.ndarray, words: pa.Array, seed: int) -> np.ndarray:
        """The hash of each word, at its number, as Spark makes it of language and word."""
        out = np.zeros(len(words), np.uint64)
        used = np.flatnonzero(np.bincount(run, minlength=len(words)))
        texts = words.take(pa.array(used)).to_pylist()
        out[used] = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in texts), np.uint64, len(used))
        return out

    def _of_1(self, run: np.ndarray, words: pa.Array, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
        count = np.bincount(run, minlength=len(words))
        count[0] = 0
        found = np.flatnonzero(count)
        return [found], count[found]

    def _of_2(self, run: np.ndarray, words: pa.Array, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
        frequent = hit(self.maps[0], self._hashes(run, words, seed))
        frequent[0] = False
        known = frequent[run]
        at = np.flatnonzero(known[:-1] & known[1:])
        code, key = pd.factorize(run[at] * len(words) + run[at + 1])
        return [key // len(words), key % len(words)], np.bincount(code)

    def _of_3(self, run: np.ndarray, words: pa.Array, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
        frequent, starts, ends = self.maps
        hashes = self._hashes(run, words, seed)[run]
        pair = pair_hash(hashes[:-1], hashes[1:])
        known = hit(frequent, pair) & (run[:-1] > 0) & (run[1:] > 0)
        grown = hit(starts, pair)[:-1] | hit(ends, pair)[1:]
        at = np.flatnonzero(known[:-1] & known[1:] & grown)
        wide = len(words)  # below 2**21, so three numbers fit
        code, key = pd.factorize((run[at] * wide + run[at + 1]) * wide + run[at + 2])
        return [key // wide**2, key // wide % wide, key % wide], np.bincount(code)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ (second >> np.uint64(17))


def hit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def counted(docs: DataFrame, size: int, *maps: Broadcast) -> DataFrame:
    """Rows ``(lang, phrase, f)`` of the phrases of ``size`` words that occur ``LEAST`` times
    or more, out of those that the bitmaps let through; for words also their total."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(size, [m.value for m in maps])
        for batch in batches:
            for lang, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from counter.add(lang, raw or b"")
        yield from counter.flush()

    found = docs.mapInArrow(run, "lang string, phrase binary, c long").groupBy("lang", F.col("phrase").cast("string").alias("phrase"))
    return found.agg(F.sum("c").alias("f")).where((F.col("f") >= LEAST) | (F.col("phrase") == ""))


def bitmap(df: DataFrame, hashed: Column) -> Broadcast:
    """Bits at the hashes of the rows; of a fixed size whatever the number of rows."""
    place = hashed.bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    cells = df.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    found = cells.toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy().astype(np.uint64)
    return df.sparkSession.sparkContext.broadcast(out)


def word_hash(word: str | Column) -> Column:
    return F.xxhash64("lang", word)


def two_words(phrase: str) -> Column:
    parts = F.split(phrase, " ", 2)
    return word_hash(parts[0]).bitwiseXOR(F.shiftrightunsigned(word_hash(parts[1]), 17))


def first_words(phrase: str, count: int) -> Column:
    return F.substring_index(phrase, " ", count)


def score(a: str, left: str, right: str) -> Column:
    """``floor(10^6 a a / (l r))`` in whole numbers."""
    return F.expr(f"CAST({MILLION} AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(16,0)) * CAST({a} AS DECIMAL(16,0)) "
                  f"DIV (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))")


def counts_of(words: DataFrame, column: str, name: str) -> DataFrame:
    return words.select("lang", F.col("phrase").alias(column), F.col("f").alias(name))


def pairs_of(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Frequent pairs with the counts of their words, their score, and the most that a longer
    phrase can occur that starts (``longer``) or ends (``before``) with them."""
    named = pairs.select("lang", "phrase", F.col("f").alias("a"), first_words("phrase", 1).alias("x"), first_words("phrase", -1).alias("y"))
    firsts = named.groupBy("lang", F.col("x").alias("y")).agg(F.max("a").alias("follows"))
    lasts = named.groupBy("lang", F.col("y").alias("x")).agg(F.max("a").alias("leads"))
    by_first = counts_of(words, "x", "l").join(lasts, ["lang", "x"], "left")
    by_last = counts_of(words, "y", "r").join(firsts, ["lang", "y"], "left")
    met = named.join(by_first, ["lang", "x"]).join(by_last, ["lang", "y"])
    return met.select(
        "lang", "phrase", "a", "l", "r", score("a", "l", "r").alias("score"),
        F.when(F.col("follows").isNotNull(), F.least("a", "follows")).alias("longer"),
        F.when(F.col("leads").isNotNull(), F.least("a", "leads")).alias("before"),
    )


def triples_of(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Frequent phrases of three words with the score of their lowest cut."""
    heads = pairs.select("lang", F.col("phrase").alias("head"), F.col("l").alias("l1"), F.col("a").alias("l2"))
    tails = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    named = triples.select("lang", "phrase", F.col("f").alias("a"), first_words("phrase", 2).alias("head"), first_words("phrase", -2).alias("tail"))
    met = named.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    met = met.withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    return met.select("lang", "phrase", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                      F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))


def surviving(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Pairs that no counted longer phrase drops, and all counted longer ones."""
    inside = [triples.select("lang", first_words("phrase", k).alias("phrase"), F.col("a").alias("most")) for k in (2, -2)]
    most = inside[0].union(inside[1]).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = pairs.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < SHARE * F.col("a")))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return kept.select(columns).union(triples.select(columns))


def thresholds(known: DataFrame, asked: int, settled: DataFrame | None, top: int) -> DataFrame:
    """Per language the score that ``asked`` of its rows reach, 0 if it has no more; a settled
    language keeps its threshold."""
    falling = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = known.groupBy("lang", "score").agg(F.count("*").alias("rows")).withColumn("reach", F.sum("rows").over(falling))
    found = ranked.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reach") >= asked, F.col("score"))), F.lit(0)).alias("next"))
    if settled is None:
        return found.select("lang", F.col("next").alias("least"), F.lit(None).cast("long").alias("old"))
    joined = found.join(settled.select("lang", F.col("least").alias("old"), "stay"), "lang")
    done = (F.col("stay") >= top) | (F.col("old") == 0)
    return joined.select("lang", F.when(done, F.col("old")).otherwise(F.least("next", F.col("old") - 1)).alias("least"), "old")


def drops() -> Column:
    """The least count at which a longer phrase drops a pair."""
    return F.greatest(F.lit(LEAST), F.ceil(F.lit(SHARE) * F.col("a") / 100))


def grows_on(least: Column) -> Column:
    """Whether longer phrases that start with a pair are counted for the threshold."""
    return (F.col("bound") >= least) | (F.col("score") >= least) & (F.col("longer") >= drops())


def grows_before(least: Column) -> Column:
    """Whether longer phrases that end in a pair are."""
    return (F.col("score") >= least) & (F.col("before") >= drops())


def newly(pairs: DataFrame, grows: Callable[[Column], Column]) -> DataFrame:
    """Pairs to grow for the threshold, but for those that earlier rounds have grown."""
    now, then = (F.coalesce(grows(F.col(c)), F.lit(False)) for c in ("least", "old"))
    return pairs.where(now & ~then)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Rows ``(lang, rank, phrase, a, l, r, n, score)``, the ``top`` of each language."""
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    counts = staged(counted(source, 1), "words")
    words = counts.where("phrase != ''")
    frequent = bitmap(words, word_hash("phrase"))
    pairs = staged(pairs_of(staged(counted(source, 2, frequent), "pair_counts"), words), "pairs")
    known_pairs = bitmap(pairs, two_words("phrase"))

    bound = F.expr(f"CAST({MILLION} AS DECIMAL(7,0)) * CAST(longer AS DECIMAL(19,0)) DIV CAST(l AS DECIMAL(19,0))")
    triples = settled = None
    known, asked = pairs, FIRST * top
    while True:
        marks = staged(thresholds(known, asked, settled, top), "thresholds")
        at = pairs.withColumn("bound", bound).join(marks, "lang")
        maps = [bitmap(newly(at, grows), two_words("phrase")) for grows in (grows_on, grows_before)]
        scored = triples_of(counted(source, 3, known_pairs, *maps), pairs)
        triples = staged(scored if triples is None else scored.union(triples).distinct(), "triples")
        known = staged(surviving(pairs, triples), "known")
        reached = known.join(marks, "lang").where("score >= least")
        stays = reached.groupBy("lang").agg(F.count("*").alias("stay"))
        settled = staged(marks.join(stays, "lang", "left").select("lang", "least", F.coalesce("stay", F.lit(0)).alias("stay")), "settled")
        if settled.where((F.col("stay") < top) & (F.col("least") > 0)).isEmpty():
            break
        asked *= 2
    best = known.join(settled.select("lang", "least"), "lang").where("score >= least")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    some = best.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "collocations", lambda: collocations(table(spark, sf_dir, "documents")))[0]


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), f1 AS (
  SELECT lang, w[i] AS phrase, count(*) AS f FROM placed GROUP BY ALL
), f2 AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM placed WHERE i + 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10
), f3 AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM placed WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang
), cuts AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, 1 AS k, f2.f AS a, p.f AS l, q.f AS r, f2.x || ' ' || f2.y AS inner1, NULL AS inner2
  FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.phrase = f2.x JOIN f1 q ON q.lang = f2.lang AND q.phrase = f2.y
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 1, f3.f, p.f, q.f, f3.x || ' ' || f3.y, f3.y || ' ' || f3.z
  FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.phrase = f3.x JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 2, f3.f, p.f, q.f, f3.x || ' ' || f3.y, f3.y || ' ' || f3.z
  FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y JOIN f1 q ON q.lang = f3.lang AND q.phrase = f3.z
), scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, inner1 AS phrase, a AS f FROM lowest WHERE inner2 IS NOT NULL
    UNION ALL SELECT lang, inner2, a FROM lowest WHERE inner2 IS NOT NULL) GROUP BY lang, phrase
), remaining AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM remaining JOIN totals USING (lang) QUALIFY rank <= 2000
"""
