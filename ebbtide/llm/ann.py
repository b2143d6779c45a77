"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. A vector gets one more component that brings its norm to
the largest one, a query is scaled to it; then the nearest in Euclidean distance are those
of largest inner product. A table hashes a vector by ``m`` random projections, cut into
slots of one width. A query visits buckets in the order of the estimated chance that a
neighbour lies in them, best first: its place in the slots and the typical distance ``r``
of a 20th neighbour give each slot's chance. It stops when the visited chances add up to
what the wanted recall asks of a table. ``r`` comes from a fixed number of sample queries
against all rows.

Buckets go to packs of bounded size, a bucket with very many vectors to several; a pack
meets the queries that visit one of its buckets, in blocks of bounded size. There the
scores are computed in double precision on the original vectors, and only a query's best
of the pack go on; the candidates of all packs and tables are merged at the end. Of equal
vectors the ``k + 1`` smallest ids are enough, as the others can't be among anyone's
``k`` nearest: Spark drops them before the shuffle. Tables below ``SMALL`` rows are one
bucket, which makes the search exact.

Defined results: vectors that are null, zero, of a length other than the most frequent
one or that hold null or non-finite components take no part, nor do rows without id;
fewer candidates than ``k`` give fewer rows; ties go to the smaller id; repeated rows of
the same id and vector count once; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.shared import staged, table

TABLES = 2
RECALL = 0.93  # wanted chance to visit a neighbour's bucket
SMALL = 2048
PACK, BLOCK = 16_384, 2_048
SAMPLE = 64
WIDTH = 1.5  # slot width in units of r
SLOTS = 4  # slots to either side that a probe may move


@dataclass(frozen=True)
class Hashes:
    """Projections of all tables: ``a`` (tables, m, dim + 1), offsets, width."""

    a: np.ndarray
    b: np.ndarray
    width: float
    radius: float
    norm: float
    share: float  # chance that the buckets visited in one table must add up to

    @staticmethod
    def drawn(rows: int, dim: int, radius: float, norm: float, tables: int, recall: float) -> Hashes:
        m = max(0, math.ceil(math.log2(max(1, rows) / SMALL) / 1.2))
        rng = np.random.default_rng(7)
        width = WIDTH * max(radius, 1e-9)
        a, b = rng.standard_normal((tables, m, dim + 1)), rng.uniform(0, width, (tables, m))
        return Hashes(a, b, width, max(radius, 1e-9), norm, 1 - (1 - recall) ** (1 / tables))

    def places(self, t: int, points: np.ndarray) -> np.ndarray:
        """Positions on the projections of a table, in slots."""
        return (points @ self.a[t].T + self.b[t]) / self.width

    def indexed(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - np.einsum("ij,ij->i", x, x), 0))
        return np.column_stack([x, rest])

    def asked(self, q: np.ndarray) -> np.ndarray:
        scale = self.norm / np.sqrt(np.einsum("ij,ij->i", q, q))
        return np.column_stack([q * scale[:, None], np.zeros(len(q))])

    def probes(self, place: np.ndarray) -> list[np.ndarray]:
        """The slots of the buckets to visit, in falling order of their chance."""
        home = np.floor(place).astype(np.int64)
        moves = np.arange(-SLOTS, SLOTS + 1)
        edges = (np.arange(-SLOTS, SLOTS + 2) - (place - home)[:, None]) * (self.width / self.radius)
        chance = np.maximum(np.diff(_normal(edges), axis=1), 1e-12)
        best = np.argsort(-chance, axis=1, kind="stable")
        logs = np.log(np.take_along_axis(chance, best, axis=1))
        steps = [row.tolist() for row in logs[:, :-1] - logs[:, 1:]]
        m, out, total = len(place), [], 0.0
        heap = [(-float(logs[:, 0].sum()), (0,) * m, 0)]
        while heap and total < self.share:
            cost, at, last = heapq.heappop(heap)
            out.append(home + moves[best[np.arange(m), list(at)]] if m else home)
            total += math.exp(-cost)
            # Each combination of moves has one parent: that with its last move undone.
            for j in range(last, m):
                if at[j] < 2 * SLOTS:
                    heapq.heappush(heap, (cost + steps[j][at[j]], (*at[:j], at[j] + 1, *at[j + 1 :]), j))
        return out


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


def codes(t: int, slots: np.ndarray) -> np.ndarray:
    """One number per bucket; two buckets with the same number would only be one."""
    slots = np.atleast_2d(slots).astype(np.uint64)
    code = np.full(len(slots), 2 * t + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(slots.shape[1]):
            code = (code ^ slots[:, j]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
    return (code >> np.uint64(1)).astype(np.int64)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows ``(id, v)`` that take part."""
    own = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(fine & F.exists("v", lambda x: x != 0))
    length = own.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return own.where(F.size("v") == (length["n"] if length else 0)).distinct()


def _matrix(column) -> np.ndarray:
    """Vectors of an Arrow list column as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` largest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _radius(rows: DataFrame, norm: float, k: int) -> float:
    """Distance within which most sample queries have ``k`` neighbours."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if not len(sample):
        return 1.0
    hashes = Hashes(np.empty((0, 0, 0)), np.empty((0, 0)), 1.0, 1.0, norm, 1.0)
    held = rows.sparkSession.sparkContext.broadcast(hashes.asked(_matrix(sample.column("v"))))

    def near(batches):
        kept = np.full((len(held.value), 0), np.inf)
        for batch in batches:
            x = hashes.indexed(_matrix(batch.column(0)))
            far = 2 * norm**2 - 2 * held.value @ x.T
            kept = np.sort(np.concatenate([kept, far], axis=1), axis=1)[:, : k + 1]
        at, values = np.repeat(np.arange(len(kept)), kept.shape[1]), kept.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(values, pa.float64())], ["q", "d"])

    order = Window.partitionBy("q").orderBy("d")
    found = rows.select("v").mapInArrow(near, "q long, d double").withColumn("rank", F.row_number().over(order))
    last = found.where(F.col("rank") <= k + 1).groupBy("q").agg(F.max("d").alias("d")).toArrow()
    return float(np.sqrt(np.quantile(np.maximum(last.column("d").to_numpy(), 0), 0.9)))


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    recall: float = RECALL,
) -> DataFrame:
    """Rows ``(query_id, rank, <key>, score)``; ``is_query`` is a condition on ``id``."""
    spark = df.sparkSession
    rows = staged(usable(df, key, vector), "vectors")
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("square"),
        F.max(F.size("v")).alias("dim"),
    ).first()
    norm = math.sqrt(facts["square"] or 1.0) * (1 + 1e-9)
    n, dim = facts["n"], facts["dim"] or 1
    hashes = Hashes.drawn(n, dim, _radius(rows, norm, k), norm, tables, recall)
    held = spark.sparkContext.broadcast(hashes)

    same = Window.partitionBy("v").orderBy("id")
    distinct = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")

    def index(batches):
        for batch in batches:
            points = held.value.indexed(_matrix(batch.column(1)))
            for t in range(tables):
                code = codes(t, np.floor(held.value.places(t, points)))
                cells = [pa.array(np.full(len(code), t)), pa.array(code), *batch.columns]
                yield pa.RecordBatch.from_arrays(cells, ["t", "code", "id", "v"])

    kind = T.StructType([*T.StructType.fromDDL("t long, code long"), *rows.schema])
    indexed = staged(distinct.mapInArrow(index, kind), "index")
    largest = indexed.groupBy("code").count().agg(F.max("count")).first()[0] or 1
    parts = math.ceil(largest / PACK)
    packs = max(1, math.ceil(n / PACK / parts))  # of each table

    def probe(batches):
        for batch in batches:
            points, out = held.value.asked(_matrix(batch.column(1))), ([], [], [])
            places = [held.value.places(t, points) for t in range(tables)]
            for i in range(len(points)):
                for t in range(tables):
                    code = codes(t, np.array(held.value.probes(places[t][i])))
                    for p in np.unique(code % packs).tolist():
                        for cell, value in zip(out, (i, t * packs + p, code[code % packs == p]), strict=True):
                            cell.append(value)
            at = pa.array(out[0], pa.int64())
            lists = pa.array(out[2], pa.list_(pa.int64()))
            cells = [*(c.take(at) for c in batch.columns), pa.array(out[1], pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(cells, ["query_id", "q", "pack", "visited"])

    # A query comes to a pack once, with the codes it visits there.
    asked = rows.where(is_query).select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    kind = T.StructType([*asked.schema, *T.StructType.fromDDL("pack long, visited array<long>")])
    routed = staged(asked.mapInArrow(probe, kind), "visits")
    loads = routed.groupBy("pack").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks"))
    loads = staged(loads, "loads")
    split = F.sequence(F.lit(0), F.lit(parts - 1))
    left = indexed.withColumns({"pack": F.col("t") * packs + F.col("code") % packs, "part": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int")})
    load = loads.select("pack", F.col("blocks").alias("times"))
    left = left.join(load, "pack").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    right = routed.join(loads, "pack").withColumns({"block": F.pmod(F.xxhash64("query_id"), "blocks"), "part": F.explode(split)})
    keys = ["pack", "part", "block"]
    left = left.select(*[F.col(c).alias(f"left_{c}") for c in keys], "code", "id", "v")
    right = right.select(*keys, "query_id", "q", "visited")

    def compare(mine: pa.Table, others: pa.Table) -> pa.Table:
        return _compared(mine, others, k)

    met = left.groupBy(*[f"left_{c}" for c in keys]).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    merged = met.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _compared(mine: pa.Table, others: pa.Table, k: int) -> pa.Table:
    """For each query of ``others`` its ``k`` best rows of the buckets it visits in ``mine``."""
    out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.float64)]
    if len(mine) and len(others):
        code = mine.column("code").to_numpy()
        at = np.argsort(code, kind="stable")
        x, ids, code = _matrix(mine.column("v"))[at], mine.column("id").to_numpy()[at], code[at]
        q, query = _matrix(others.column("q")), others.column("query_id").to_numpy()
        lists = others.column("visited").combine_chunks()
        visited, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        who = np.repeat(np.arange(len(q)), lengths)
        bucket, starts = np.unique(code, return_index=True)
        ends = np.append(starts[1:], len(code))
        scores = np.full((min(len(q), 256), len(x)), -np.inf)
        # What two sums of the same products can differ by.
        margin = 4 * x.shape[1] * np.finfo(x.dtype).eps * np.sqrt((x * x).sum(axis=1).max())
        norm = np.sqrt((q * q).sum(axis=1))
        for first in range(0, len(q), 256):
            scores[:] = -np.inf
            here = (who >= first) & (who < first + 256)
            number = np.searchsorted(bucket, visited[here])
            known = (number < len(bucket)) & (bucket[np.minimum(number, len(bucket) - 1)] == visited[here])
            number, rows = number[known], who[here][known] - first
            for b in np.unique(number).tolist():
                chosen, part = rows[number == b], slice(starts[b], ends[b])
                scores[chosen, part] = q[first + chosen] @ x[part].T
            # Every row that may be among the best once scores are exact, the query's own besides.
            after = max(0, len(x) - k - 1)
            least = np.partition(scores, after, axis=1)[:, after]
            for i in range(min(256, len(q) - first)):
                j = np.flatnonzero((scores[i] >= least[i] - margin * norm[first + i]) & np.isfinite(scores[i]))
                j = j[ids[j] != query[first + i]]
                exact = (x[j] * q[first + i]).sum(axis=1)
                j, exact = (v[_best(ids[j], exact, k)] for v in (j, exact))
                out[0].append(np.full(len(j), query[first + i]))
                out[1].append(ids[j])
                out[2].append(exact)
    made = [np.concatenate(c) for c in out]
    return pa.table({"query_id": pa.array(made[0], pa.int64()), "id": pa.array(made[1], pa.int64()), "score": made[2]})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
