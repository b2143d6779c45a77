"""N-gram Jaccard join with several global token orders.

Tokens are the 64-bit hashes of a document's distinct shingles of five words; two
documents link when their sets have a Jaccard similarity of at least 0.75. Two linked
sets share a token among the first ``n - ceil(0.75 n) + 1`` of each, under any order of
all tokens. The first order puts rare tokens first: tokens that many documents hold are
counted over all documents, the most frequent come last, by count, and the others by
hash. An index of the prefixes under this order gives the candidates. Two further orders
are permutations of the hashes; a candidate pair must share a prefix token under each of
them too before its whole sets are compared.

Equal sets are one node, keyed by a digest of the set. A frequent token joins a large
group of nodes, and the result needs components, not pairs; so no group is expanded:

1. Every node of a token's group is compared with one of them, the group's centre: the
   one with the fewest tokens before the shared one, so that among copies with changes
   it is one with few changes. The links give components.
2. Groups whose nodes are then all in one component are done: no further link could
   change the result. In the others, each node outside the group's largest component
   is compared with the nodes of other components. The links of both steps together
   give the components.

A pair meets at a shared token only if the tokens that follow it in either are enough
for a link. So every link between different components is found, and the pairs left out are those
inside a component. Tokens of all documents are counted and grouped in buckets of the
hash: tasks send packed arrays, in which a token has one entry a task, and a bucket holds
a fixed number of tokens. Groups of frequent tokens travel as rows, spread by node, and
are aggregated and joined by Spark, which splits skewed joins.

Defined results: a null text, or one without words, has no shingle and links with
nothing; fewer than five words are one shingle; repeated rows and equal texts link;
a null doc_id stays null and loses against any other as component_id; an empty table
gives an empty table; further columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ebbtide.llm.graph import components
from ebbtide.llm.shared import finished, shared_path, small_batches, staged, table, tidy

SHINGLE = 5
PERCENT = 75
FREQUENT = 1 << 18  # most tokens in the broadcast list of frequent ones
LEAST_DF = 8  # documents a token must be in to be listed
BUCKET_TOKENS = 1 << 18
FLUSH = 1 << 20
WORDS_KEPT = 1 << 17
ROW_GROUP = 16 << 20  # bytes that a task buffers while it stores parcels

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ORDERS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


class Words(dict):
    """Hashes of words, kept up to a number of entries."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_FACTORS = _mixed(np.arange(1, SHINGLE + 2, dtype=np.uint64)) | np.uint64(1)


def tokens(text: bytes | None, kept: Words) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = text.translate(LOWER).split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(kept.__getitem__, words), np.uint64, n)
    wide = min(n, SHINGLE)
    with np.errstate(over="ignore"):
        total = np.full(n - wide + 1, np.uint64(wide) * _FACTORS[-1], np.uint64)
        for k in range(wide):
            total += hashes[k : n - wide + 1 + k] * _FACTORS[k]
    return np.unique(_mixed(total))


def digest(found: np.ndarray) -> bytes | None:
    """Names a set of tokens."""
    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def prefix(found: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The tokens that come first under ``order``, as many as a link must touch."""
    length = prefix_length(len(found))
    return found if length >= len(found) else found[np.argpartition(order, length - 1)[:length]]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The further orders first, then the sets."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < PERCENT * large:
        return False
    for factor in ORDERS:
        with np.errstate(over="ignore"):
            mine, other = prefix(a, a * factor), prefix(b, b * factor)
        if not len(np.intersect1d(mine, other, assume_unique=True)):
            return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (small + large - common)


class Frequent:
    """The listed tokens by their leading bits, and the first global order."""

    def __init__(self, bits: int, keys: np.ndarray, counts: np.ndarray) -> None:
        self.shift = np.uint64(32 - bits)
        at = np.argsort(keys)
        self.keys = keys[at]
        by_count = np.lexsort((keys, counts))
        rank = np.empty(len(keys), np.uint64)
        rank[by_count] = np.arange(len(keys), dtype=np.uint64)
        self.rank = rank[at] | np.uint64(1 << 63)

    def order(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sort keys of tokens, and which of them are listed."""
        if not len(self.keys):
            return found >> np.uint64(1), np.zeros(len(found), bool)
        key = found >> self.shift
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        listed = self.keys[at] == key
        return np.where(listed, self.rank[at], found >> np.uint64(1)), listed


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    kept = Words()
    for batch in batches:
        for cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield *cells[:-1], tokens(cells[-1], kept)


def _parcels(bits: int, arrays: dict[str, np.ndarray], by: np.ndarray, names: list[str]) -> Iterator[dict]:
    """The arrays cut by the leading bits of ``by``: packed bytes per bucket."""
    bucket = (by >> np.uint64(64 - bits)).astype(np.int64)
    at = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[at], np.arange((1 << bits) + 1))
    arrays = {k: v[at] for k, v in arrays.items()}
    for k in np.flatnonzero(np.diff(ends)).tolist():
        part = {name: v[ends[k] : ends[k + 1]].tobytes() for name, v in arrays.items()}
        yield {"bucket": k} | {name: part.get(name) for name in names}


def _joined(group: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in group.column(name).to_pylist() if x), kind)


def _nodes_and_counts(docs: DataFrame, doc_id: str, text: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """Documents ``(id, text_hash, node, n)``, and tokens ``(token, df)`` that at least
    ``LEAST_DF`` nodes or copies hold; a token is given by its leading ``bits + 32`` bits.
    One pass over the texts stores the documents and the parcels of tokens; the parcels
    alone are grouped, as copies of one text may be most of the documents."""
    source = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("binary").alias("text")
    )
    own = [source.schema["id"], *T.StructType.fromDDL("text_hash long, node binary, n long")]
    sent = T.StructType([*own, *T.StructType.fromDDL("bucket int, once binary, often binary, times binary")])
    arrow = pa.schema([(f.name, k) for f, k in zip(sent, _kinds(sent), strict=True)])
    names = ["once", "often", "times"]
    none = dict.fromkeys(sent.names)
    cut = np.uint64(32 - bits)

    def count(batches):
        found, seen, held, rows = [], set(), 0, []

        def counted():
            all_tokens, times = np.unique(np.concatenate(found) >> cut << cut, return_counts=True)
            key = (all_tokens >> cut).astype(np.uint32)
            single = times == 1
            for part in _parcels(bits, {"once": key[single]}, all_tokens[single], names):
                yield none | part
            more = {"often": key[~single], "times": times[~single].astype(np.uint32)}
            for part in _parcels(bits, more, all_tokens[~single], names):
                yield none | part

        for doc, text_hash, mine in _texts(batches):
            node = digest(mine)
            rows.append(none | {"id": doc, "text_hash": text_hash, "node": node, "n": len(mine)})
            if node is not None and node not in seen:
                seen.add(node)
                found.append(mine)
                held += len(mine)
            if held >= FLUSH or len(rows) >= 10_000:
                yield pa.RecordBatch.from_pylist(rows, arrow)
                rows = []
            if held >= FLUSH:
                yield pa.RecordBatch.from_pylist(list(counted()), arrow)
                found, seen, held = [], set(), 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)
        if found:
            yield pa.RecordBatch.from_pylist(list(counted()), arrow)

    def add_up(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        once, often = _joined(group, "once", np.uint32), _joined(group, "often", np.uint32)
        key, at = np.unique(np.concatenate([once, often]), return_inverse=True)
        times = np.concatenate([np.ones(len(once), np.int64), _joined(group, "times", np.uint32)])
        df = np.bincount(at, times, len(key)).astype(np.int64)
        many = df >= LEAST_DF
        token = (np.int64(bucket) << np.int64(32)) | key[many].astype(np.int64)
        return pa.table({"token": token, "df": df[many]})

    path = shared_path(docs.sparkSession, "nodes")
    source.mapInArrow(tidy(count), sent).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    stored = docs.sparkSession.read.schema(sent).parquet(path)
    parcels = stored.where("bucket is not null").select("bucket", *names)
    found = parcels.groupBy("bucket").applyInArrow(add_up, "token long, df long")
    return stored.where("n is not null").select([f.name for f in own]), found


def _kinds(schema: T.StructType) -> list[pa.DataType]:
    return [to_arrow_type(f.dataType) for f in schema]


def _index(docs: DataFrame, text: str, bits: int, held) -> DataFrame:
    """Rows ``(token, node, n, at)`` of prefix tokens under the first order with their
    position, of tokens in the prefixes of two nodes at least; a node goes by the first
    half of its digest."""
    sent = T.StructType.fromDDL("bucket int, token binary, node binary, n binary, at binary, listed boolean")
    kept = T.StructType.fromDDL("token long, node long, n long, at long")
    arrow = pa.schema([(f.name, k) for f, k in zip(sent, _kinds(sent), strict=True)])
    names = ["token", "node", "n", "at"]

    def prefixes(batches):
        frequent = Frequent(*held.value)
        rare, often, seen, size = [], [], set(), 0

        def parcels():
            for listed, kept_rows in ((False, rare), (True, often)):
                if kept_rows:
                    cells = dict(zip(names, map(np.concatenate, zip(*kept_rows, strict=True)), strict=True))
                    by = _mixed(cells["node"].astype(np.uint64)) if listed else cells["token"]
                    for part in _parcels(bits, cells, by, names):
                        yield part | {"listed": listed}

        for (mine,) in _texts(batches):
            if not len(mine):
                continue
            name = digest(mine)
            if name in seen:
                continue
            seen.add(name)
            order, listed = frequent.order(mine)
            length = prefix_length(len(mine))
            first = np.argsort(order)[:length]
            key = int.from_bytes(name[:8], "big", signed=True)
            for to, at in ((rare, np.flatnonzero(~listed[first])), (often, np.flatnonzero(listed[first]))):
                if len(at):
                    n = np.full(len(at), len(mine), np.int32)
                    to.append((mine[first[at]], np.full(len(at), key), n, at.astype(np.int32)))
            size += length
            if size >= FLUSH:
                yield pa.RecordBatch.from_pylist(list(parcels()), arrow)
                rare, often, seen, size = [], [], set(), 0
        if size:
            yield pa.RecordBatch.from_pylist(list(parcels()), arrow)

    def shared(group: pa.Table) -> pa.Table:
        parts = []
        for listed in (False, True):
            rows = group.filter(pc.equal(group.column("listed"), listed))
            token, node = _joined(rows, "token", np.uint64), _joined(rows, "node", np.int64)
            by = np.lexsort((node, token))
            new = (token[by[1:]] != token[by[:-1]]) | (node[by[1:]] != node[by[:-1]])
            by = by[np.concatenate([[True], new])[: len(by)]]
            if not listed and len(by):
                same = token[by[1:]] == token[by[:-1]]
                by = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
            n, at = (_joined(rows, c, np.int32).astype(np.int64)[by] for c in ("n", "at"))
            parts.append(pa.table({"token": token[by].view(np.int64), "node": node[by], "n": n, "at": at}))
        return pa.concat_tables(parts)

    source = docs.select(F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(tidy(prefixes), sent).groupBy("bucket").applyInArrow(shared, kept)


def _fits(a: str, b: str) -> Column:
    """Sizes that allow a link, if the shared token is the first that both have: then no
    more tokens are common than follow it in either. A linked pair passes at its first."""
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    most = F.least(n_a - F.col(f"at_{a}"), n_b - F.col(f"at_{b}"))
    enough = (100 + PERCENT) * most >= PERCENT * (n_a + n_b)
    return enough & (100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b))


def _as(side: str, *columns: str) -> list[Column]:
    """``node`` under the name of a side of a pair, other columns with it as a suffix."""
    return [F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]]


def _pairs(df: DataFrame) -> DataFrame:
    pair = df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.distinct()


def _bitmap(keys: DataFrame, key: str, bits: int = 1 << 23) -> np.ndarray:
    """Which of ``bits`` positions the keys fall on: at most 1 MB, whatever their number."""
    at = F.pmod(F.col(key), F.lit(bits)) + 1  # Spark counts bitmap positions from one
    parts = (
        keys.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    held = np.zeros(bits // 8 + 4096, np.uint8)
    for r in parts:
        start = (r["part"] - 1) * 4096
        held[start : start + 4096] = np.frombuffer(r["bits"], np.uint8)
    return held


def _with_texts(docs: DataFrame, text: str, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows ``(key, text)``, one text for each node of the pairs. A bitmap of bounded size
    keeps most other texts out of the join; it may let some through, never too few."""
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    chosen = nodes.join(wanted, "key").groupBy("key").agg(F.min("text_hash").alias("text_hash"))
    chosen = staged(chosen, "chosen")
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(chosen, "text_hash"))

    @F.pandas_udf("boolean")
    def maybe(hashes):
        at = hashes.to_numpy() % (1 << 23)
        return hashes.notna() & ((bitmap.value[at // 8] >> (at % 8)) & 1 == 1)

    texts = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).cast("binary").alias("text"))
    some = texts.where(maybe("text_hash")).join(chosen, "text_hash")
    return some.groupBy("key").agg(F.first("text").alias("text"))


def _links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that link, by the digests of their sets."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("text_a", "text_b")

    def verify(batches):
        kept, last = Words(), {}

        def read(text):
            if text not in last:
                if len(last) >= 64:
                    last.clear()
                last[text] = tokens(text, kept)
            return last[text]

        for batch in batches:
            found = [], []
            for text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = read(text_a), read(text_b)
                if linked(a, b):
                    found[0].append(digest(a))
                    found[1].append(digest(b))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in found], ["a", "b"])

    return both.mapInArrow(tidy(verify), "a binary, b binary")


def clusters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(id, text_hash, node, n, root)``, one per row of ``docs``: size of its set
    and the key of its component (``root`` is null without shingles)."""
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = min(24, max(2, math.ceil(math.log2(max(1, size / 6 / BUCKET_TOKENS)))))
    nodes, counts = _nodes_and_counts(docs, doc_id, text, bits)
    nodes = nodes.select("id", "text_hash", "node", "n", _key("node").alias("key"))
    top = counts.orderBy(F.desc("df"), "token").limit(FREQUENT).toArrow()
    listed = [top.column(c).to_numpy().astype(k) for c, k in (("token", np.uint64), ("df", np.int64))]
    held = spark.sparkContext.broadcast((bits, *listed))
    index = staged(_index(docs, text, bits, held), "index")

    centre = index.groupBy("token").agg(F.min(F.struct("at", "node", "n")).alias("centre"))
    centre = centre.select("token", "centre.*").select("token", *_as("a", "n", "at"))
    centred = index.select("token", *_as("b", "n", "at")).join(centre, "token")
    stars = staged(_pairs(centred.where((F.col("a") != F.col("b")) & _fits("a", "b"))), "stars")
    links = staged(_links(_with_texts(docs, text, nodes, stars), stars), "links")
    found = components(links)

    rest = staged(_open_pairs(index, found, stars), "rest")
    if not rest.isEmpty():
        more = _links(_with_texts(docs, text, nodes, rest), rest)
        found = components(links.union(more))
    found = found.select("node", "root")
    return nodes.drop("key").join(found, "node", "left").select(
        "id", "text_hash", "node", "n", F.coalesce("root", "node").alias("root")
    )


def _key(node: str) -> Column:
    """The first half of a digest as a number, the way the index names nodes."""
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long")


def _open_pairs(index: DataFrame, found: DataFrame, tested: DataFrame) -> DataFrame:
    """Untested pairs of nodes that share a token and lie in different components."""
    roots = found.select(_key("node").alias("node"), _key("root").alias("root")).groupBy("node").agg(F.min("root").alias("root"))
    placed = index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = (
        placed.groupBy("token", "root")
        .agg(F.count("*").alias("members"))
        .groupBy("token")
        .agg(F.sum("members").alias("size"), F.max(F.struct("members", "root"))["root"].alias("main"), F.count("*").alias("parts"))
        .where("parts > 1 and size > 2")
        .select("token", "main")
    )
    inside = staged(placed.join(groups, "token"), "open")
    out = inside.where("root != main").select("token", *_as("a", "n", "at", "root"))
    other = inside.select("token", *_as("b", "n", "at", "root"), "main")
    met = out.join(other, "token").where(
        (F.col("root_a") != F.col("root_b"))
        & ((F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b")))
        & _fits("a", "b")
    )
    return _pairs(met).join(tested, ["a", "b"], "left_anti")


def join_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(<doc_id>, n_shingles, component_id)``, one per row of ``docs``."""
    placed = staged(clusters(docs, doc_id, text), "placed")
    # Stored, so that the join is one of plain tables, whose large partitions Spark splits.
    least = staged(placed.where("root is not null").groupBy("root").agg(F.min("id").alias("least")), "least")
    return placed.join(least, "root", "left").select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of ``docs`` with all columns, one of each component: that of the
    smallest id, then text hash. Documents without words stay."""
    placed = staged(clusters(docs, doc_id, text), "placed").where("root is not null")
    first_row = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash"))
    least = staged(placed.groupBy("root").agg(first_row.alias("least")), "least")
    members = placed.groupBy("root", "id", "text_hash").agg(F.count("*").alias("copies")).join(least, "root")
    first = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.text_hash"))
    members = staged(members.select("id", "text_hash", "copies", first.alias("first")), "members")
    marked = docs.withColumns({"__hash": F.xxhash64(text)})
    same = lambda other: marked[doc_id].eqNullSafe(other["id"]) & (marked["__hash"] == other["text_hash"])
    gone = members.where("not first")
    kept = marked.join(gone, same(gone), "left_anti")
    repeated = members.where("first and copies > 1")
    if not repeated.isEmpty():
        twice = lambda how: kept.join(repeated, kept[doc_id].eqNullSafe(repeated["id"]) & (kept["__hash"] == repeated["text_hash"]), how)
        kept = twice("left_anti").unionByName(twice("left_semi").dropDuplicates([doc_id, "__hash"]))
    return kept.drop("__hash")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "components", lambda: join_components(table(spark, sf_dir, "documents")))[0]


SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g
  FROM docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM docs
  UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT docs.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(reach.y) AS component_id
FROM docs LEFT JOIN size USING (doc_id) JOIN reach ON reach.x = docs.doc_id GROUP BY docs.doc_id
"""
