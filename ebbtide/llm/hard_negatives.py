"""Hard negatives by angular triangle filtering.

Vectors become whole numbers, ``floor(256 x)``, and a score is their inner product with an
anchor. An anchor's positives are its best rows of the same label; the hard negatives of an
anchor and a positive are the best rows of other labels whose score lies in a window given
by the positive's.

With every row are stored its norm and its angles to a few reference directions. Angles obey
the triangle inequality: if a row lies at angle ``t`` from a reference and the anchor at angle
``s``, the two are between ``|s - t|`` and ``min(s + t, 2 pi - s - t)`` apart. The narrowest of these
intervals over all references, turned to cosines and multiplied by both norms, bounds the
score; it is widened by more than rounding can do. Rows lie in tiles, by nearest reference
and angle, and the ranges of angle and norm of a tile bound all of its scores at once; single
rows are bounded from the references nearest to the anchor alone, as all of them would take
longer than the score. For
positives an anchor visits tiles by falling bound until the next one is below its last
positive so far; for negatives it visits the tiles, and in them the rows, whose interval
overlaps one of its windows. Only these get integer scores, so the result is exact
whatever the references.

Rows are dealt out by label and a hash into parts of bounded size, anchors into blocks; a part
meets the blocks of a stated set of queries, one task for each, and only the best few of a
part go on. A frequent label has several parts, so no task holds a label.

References are chosen from a sample of ``SAMPLE`` rows, each the one farthest from those
before; they decide how much is filtered, not what is found.

Defined results: rows without id, label or vector, with an empty vector, a null or
non-finite component, or of a length other than the most frequent one take no part; zero
vectors do, at score 0; of several rows with one id that of the least label, then vector,
counts; ties go to the smaller id; anchors without a positive, and positives whose window
holds no row, have no result; a score that 64 bits can't hold ends the job; an empty table
gives an empty table; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import finished, staged, table

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of a positive's score between which negatives lie
REFERENCES, SAMPLE = 12, 2048
PART, BLOCK = 1 << 20, 1 << 18  # components of the vectors that a task holds of either side
TILE = 64
SHARP = 2  # references nearest to an anchor, whose intervals are the narrowest, that bound single rows
SLACK = 1e-5  # radians; more than the arc cosines of rounded products of 10,000 terms are off
EXACT = 2.0**53  # below it, sums of whole numbers are exact in doubles


def whole(df: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """Rows ``(id, label, v)`` that take part, with whole components."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id is not null and label is not null and size(v) > 0").where(fine)
    length = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    rows = rows.where(F.size("v") == (length["n"] if length else 0))
    scaled = F.transform("v", lambda x: x * 256)
    # Doubles from 2^53 on are whole already.
    floored = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select("id", "label", floored.alias("v"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.*")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def norms(v: np.ndarray) -> np.ndarray:
    # Scaled first, as squares may pass the range of doubles.
    top = np.maximum(np.abs(v).max(axis=1, initial=0), 1e-300)
    return top * np.sqrt(np.square(v / top[:, None]).sum(axis=1))


def angles(v: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of the rows to the references; a zero vector is at a right angle to all."""
    unit = v / np.maximum(norms(v), 1e-300)[:, None]
    return np.arccos(np.clip(unit @ directions.T, -1, 1))


def references(rows: DataFrame) -> np.ndarray:
    """Unit vectors of a sample, each the farthest from those before it."""
    sample = rows.select("id", "label", "v").where(F.exists("v", lambda x: x != 0)).orderBy(F.xxhash64("id"), "id", "label", "v").limit(SAMPLE).toArrow()
    if not len(sample):
        return np.zeros((0, 0))
    v = matrix(sample.column("v"))
    unit = v / norms(v)[:, None]
    chosen = [unit[0]]
    nearest = unit @ chosen[0]
    while len(chosen) < min(REFERENCES, len(unit)):
        chosen.append(unit[np.argmin(nearest)])
        nearest = np.maximum(nearest, unit @ chosen[-1])
    return np.array(chosen)


def with_angles(rows: DataFrame, directions: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(2))
            if not np.isfinite(norms(v)).all():
                raise OverflowError("a score does not fit into 64 bits")
            found = angles(v, directions.value) if len(directions.value) else np.zeros((len(v), 0))
            lists = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(norms(v))], ["id", "label", "v", "angles", "norm"])

    return rows.mapInArrow(run, "id long, label long, v array<double>, angles array<double>, norm double")


def cosines(least: np.ndarray, most: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most cosine between an anchor at angles ``anchor`` to the references and
    rows whose angles lie from ``least`` to ``most`` (rows by references)."""
    apart = np.maximum(np.maximum(least - anchor, anchor - most), 0) - SLACK
    near = np.clip(apart, 0, np.pi).max(axis=-1, initial=0.0)
    # s + t up to pi, else the way round: the largest over the range is at t = pi - s.
    together = np.where((least + anchor <= np.pi) & (most + anchor >= np.pi), np.pi, np.pi - np.minimum(np.abs(np.pi - least - anchor), np.abs(np.pi - most - anchor)))
    far = np.clip(together + SLACK, 0, np.pi).min(axis=-1, initial=np.pi)
    return np.cos(far), np.cos(near)


def bounds(low: np.ndarray, high: np.ndarray, short: np.ndarray, long: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Scores for cosines from ``low`` to ``high`` and norms from ``short`` to ``long``."""
    give = 1e-9 * long * norm + 1e-6
    return np.minimum(low * short, low * long) * norm - give, np.maximum(high * short, high * long) * norm + give


@dataclass
class Part:
    """Rows in tiles by nearest reference and angle, with the ranges of each tile."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    angles: np.ndarray
    norms: np.ndarray
    starts: np.ndarray
    least: np.ndarray
    most: np.ndarray
    short: np.ndarray
    long: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Part:
        angle = matrix(rows.column("angles")) if len(rows) else np.zeros((0, 0))
        if angle.shape[1]:
            order = np.lexsort((angle.min(axis=1), angle.argmin(axis=1)))
        else:
            order = np.arange(len(rows))
        ids, labels, norm = (rows.column(c).to_numpy()[order] for c in ("id", "label", "norm"))
        angle, starts = angle[order], np.arange(0, len(rows), TILE)
        least, most = (f.reduceat(angle, starts, axis=0) if angle.shape[1] else angle[starts] for f in (np.minimum, np.maximum))
        short, long = np.minimum.reduceat(norm, starts), np.maximum.reduceat(norm, starts)
        return cls(ids, labels, matrix(rows.column("v"))[order], angle, norm, starts, least, most, short, long)

    def tiles(self, anchor: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and most score of each tile."""
        return bounds(*cosines(self.least, self.most, anchor), self.short, self.long, norm)

    def rows(self, at: np.ndarray, anchor: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and most score of each of the rows ``at``."""
        sharp = np.argsort(anchor, kind="stable")[:SHARP]
        near = self.angles[np.ix_(at, sharp)]
        return bounds(*cosines(near, near, anchor[sharp]), self.norms[at], self.norms[at], norm)

    def within(self, tiles: np.ndarray) -> np.ndarray:
        """The rows of these tiles."""
        at = (self.starts[tiles][:, None] + np.arange(TILE)).reshape(-1)
        return at[at < len(self.ids)]

    def scores(self, at: np.ndarray, v: np.ndarray, norm: float) -> np.ndarray:
        return inner(self.v[at], v, norm * self.norms[at].max(initial=0.0))


def inner(rows: np.ndarray, v: np.ndarray, most: float) -> np.ndarray:
    """Whole inner products; ``most`` bounds every sum of products but for rounding."""
    if most < EXACT / 2:
        return (rows @ v).astype(np.int64)
    if np.abs(rows).max() < 2.0**63 and np.abs(v).max() < 2.0**63:
        found = [sum(int(x) * int(y) for x, y in zip(row, v, strict=True)) for row in rows]
        if all(-(2**63) <= s < 2**63 for s in found):
            return np.array(found, np.int64)
    raise OverflowError("a score does not fit into 64 bits")


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Indexes of the highest scores, ties to the smaller id."""
    if len(scores) > count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:count]]
    return np.lexsort((ids, -scores))[:count]


def positives_in(part: Part, anchor: int, v: np.ndarray, angle: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """The best rows of a part that holds the anchor's label: ids and scores."""
    _, high = part.tiles(angle, norm)
    order = np.argsort(-high, kind="stable")
    ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for first in range(0, len(order), 8):
        tiles = order[first : first + 8]
        if len(ids) == POSITIVES:
            tiles = tiles[high[tiles] >= scores[-1]]
            if not len(tiles):
                break
        at = part.within(tiles)
        if len(ids) == POSITIVES:
            at = at[part.rows(at, angle, norm)[1] >= scores[-1]]
        at = at[part.ids[at] != anchor]
        ids, scores = np.append(ids, part.ids[at]), np.append(scores, part.scores(at, v, norm))
        held = best(scores, ids, POSITIVES)
        ids, scores = ids[held], scores[held]
    return ids, scores


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most whole score that is a hard negative of a positive's score."""
    exact = [(-(-LOW * p // 100), HIGH * p // 100) for p in positive.tolist()]
    return tuple(np.array([e[k] for e in exact], np.int64) for k in (0, 1))


def negatives_in(part: Part, label: int, v: np.ndarray, angle: np.ndarray, norm: float, positive: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each positive score its number and the best rows of a part in its window."""
    least, most = window(positive)
    open_ = least <= most  # no score is in the window of a negative one
    if not open_.any():
        return
    bottom, top = least[open_].min(), most[open_].max()
    low, high = part.tiles(angle, norm)
    at = part.within(np.flatnonzero((low <= top) & (high >= bottom)))
    at = at[part.labels[at] != label]
    low, high = part.rows(at, angle, norm)
    at = at[((low[:, None] <= most[open_]) & (high[:, None] >= least[open_])).any(axis=1)]
    scores = part.scores(at, v, norm)
    for k in np.flatnonzero(open_).tolist():
        inside = np.flatnonzero((scores >= least[k]) & (scores <= most[k]))
        chosen = inside[best(scores[inside], part.ids[at[inside]], NEGATIVES)]
        if len(chosen):
            yield k, part.ids[at[chosen]], scores[chosen]


def met(rows: DataFrame, anchors: DataFrame, by: str, width: int, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply ``run(part, block)`` to every part of the rows and every block of the anchors
    that agree on ``by``; both are of bounded size."""

    def numbered(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy(by).agg(F.ceil(F.count("*") / F.lit(max(TILE, size // width))).alias(name))

    sizes = staged(numbered(rows, PART, "parts").join(numbered(anchors, BLOCK, "blocks"), by), "sizes")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.col(f"{own}s")).alias(own)
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)).alias(other)
        return df.join(sizes, by).select(*df.columns, place, others)

    keys = [by, "part", "block"]
    left, right = dealt(rows, "part", "block"), dealt(anchors, "block", "part")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


ANCHOR = ["id", "label", "v", "angles", "norm"]
POSITIVE = "id long, positive_id long, positive_score long"
NEGATIVE = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def result(columns: list[list], schema: str) -> pa.Table:
    """Whole numbers as the columns of a schema."""
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns], names)


def unpacked_anchors(block: pa.Table) -> Iterator[tuple]:
    """Id, label, vector, angles and norm of each anchor."""
    parts = [block.column(c) for c in ANCHOR]
    return zip(parts[0].to_pylist(), parts[1].to_pylist(), matrix(parts[2]), matrix(parts[3]), parts[4].to_pylist(), strict=True)


def find_positives(mine: pa.Table, others: pa.Table) -> pa.Table:
    out = [], [], []
    if len(mine) and len(others):
        part = Part.of(mine)
        for anchor, _, v, angle, norm in unpacked_anchors(others):
            found, scores = positives_in(part, anchor, v, angle, norm)
            for cell, values in zip(out, (np.full(len(found), anchor), found, scores), strict=True):
                cell.append(values)
    return result(out, POSITIVE)


def find_negatives(mine: pa.Table, others: pa.Table) -> pa.Table:
    out = [], [], [], [], []
    if len(mine) and len(others):
        part = Part.of(mine)
        for (anchor, label, v, angle, norm), positives in zip(unpacked_anchors(others), others.column("positives").to_pylist(), strict=True):
            scored = np.array([p["positive_score"] for p in positives], np.int64)
            for k, found, scores in negatives_in(part, label, v, angle, norm, scored):
                columns = anchor, positives[k]["positive_id"], found, scored[k], scores
                for cell, values in zip(out, columns, strict=True):
                    cell.append(np.broadcast_to(values, len(found)))
    return result(out, NEGATIVE)


def hard_negatives(df: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """Rows ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``;
    ``is_anchor`` is a condition on ``id``."""
    spark = df.sparkSession
    plain = staged(whole(df, key, label, vector), "whole")
    directions = references(plain)
    width = max(1, directions.shape[1])
    # A stored column, as a join by a literal would be planned as a product.
    rows = staged(with_angles(plain, spark.sparkContext.broadcast(directions)).withColumn("pool", F.lit(0)), "angles")
    anchors = staged(rows.where(is_anchor), "anchors")

    labelled = met(rows, anchors, "label", width, find_positives, POSITIVE)
    order = Window.partitionBy("id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = labelled.withColumn("k", F.row_number().over(order)).where(F.col("k") <= POSITIVES)
    few = chosen.groupBy("id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = staged(anchors.join(few, "id"), "asked")

    found = met(rows, asked, "pool", width, find_negatives, NEGATIVE)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    labelled = vectors.withColumn("label", moved)
    return finished(spark, "negatives", lambda: hard_negatives(labelled, F.col("id") % 100 == 0))[0]


SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON r.vec_id != a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
QUALIFY rank <= 10
"""
