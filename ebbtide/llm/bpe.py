"""Byte-level BPE encoding and decoding with segment trees of pair ranks.

A text is split by the tokenizer's pattern and each match is merged on its own. Over
the byte positions of a match stands a segment tree; the leaf of a live position holds
``rank * size + position`` of the pair that starts there, so the root names the leftmost
pair of the lowest rank. A merge gives the left position the merged token, empties the
right one and updates the three leaves it touches, each along one path to the root.

Short matches are merged together: one forest of equally large trees in arrays, a step
of which does one merge in every tree that still has a pair. A long match has a tree of
its own. A task keeps what it has merged, up to a number of entries, and merges again what
it has dropped, so memory is bounded and the results don't depend on it.

Defined results: null is encoded as the empty text, which has no token; bytes that are
no UTF-8 become U+FFFD; the rank file has all 256 single bytes; rows are independent,
so repeated rows and further columns pass; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.shared import ROW, map_texts, table

RANKS = "byte_bpe_multi_50k.tiktoken"
FOREST_BYTES = 64
KEPT = 100_000
BATCH = 500
NONE = np.iinfo(np.int32).max
# A match never goes on over a space that a character other than white space follows.
JOINT = re.compile(r"(?= \S)")
LOOSE = re.compile(r" (?!\S)")  # a space of another kind


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks of tokens and of pairs of tokens, and the tokens by rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.text = {i: str(i) for i in self.token}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = (
            (ranks[t[:k]] << 32 | ranks[t[k:]], i)
            for t, i in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        )
        packed = np.fromiter(chain.from_iterable(pairs), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = packed[np.argsort(packed[:, 0])].T.copy()

    @cached_property
    def pair(self) -> dict[int, int]:
        """Ranks of pairs by key, for one long match at a time."""
        return dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """What the leaves at positions ``at`` hold; ids below 0 stand for no token."""
        key = left.astype(np.int64) << 32 | right
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = (self.pair_keys[i] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[i] * size + at, NONE)

    def merge_forest(self, pieces: list[bytes]) -> list[bytes]:
        """Packed token ids of pieces of at most ``FOREST_BYTES``, by size class."""
        out = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            classes.setdefault(1 << max(0, len(p) - 1).bit_length(), []).append(k)
        for size, members in classes.items():
            for ids, k in zip(self._merge_class([pieces[k] for k in members], size), members, strict=True):
                out[k] = ids
        return out

    def _merge_class(self, pieces: list[bytes], size: int) -> list[bytes]:
        n, wide = len(pieces), size + 2
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        # Columns 1 to size are the positions; the outer ones stand for no neighbour.
        ids = np.full((n, wide), -1, np.int32)
        ids[:, 1:-1] = np.where(np.arange(size) < lengths[:, None], self.byte[raw], -1)
        after = np.tile(np.minimum(np.arange(wide) + 1, wide - 1).astype(np.int16), (n, 1))
        before = np.tile(np.maximum(np.arange(wide) - 1, 0).astype(np.int16), (n, 1))
        tree = np.full((n, 2 * size), NONE, np.int32)
        place = np.broadcast_to(np.arange(size), (n, size))
        tree[:, size:] = self.leaves(ids[:, 1:-1], ids[:, 2:], place, size)
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2

        flat_tree = tree.reshape(-1)

        def put(row, position, value):
            node, base = position.astype(np.int64) + (size - 1), row * (2 * size)
            flat_tree[base + node] = value
            while node[0] > 1:  # all leaves are equally deep
                node >>= 1
                child = base + 2 * node
                flat_tree[base + node] = np.minimum(flat_tree[child], flat_tree[child + 1])

        row = np.flatnonzero(tree[:, 1] < NONE) if size > 1 else np.empty(0, np.int64)
        while len(row):
            root = tree[row, 1]
            left = root % size + 1
            right = after[row, left]
            ids[row, left] = root // size
            ids[row, right] = -1
            follower = after[row, right]
            after[row, left] = follower
            before[row, follower] = left
            leader = before[row, left]
            put(row, right, NONE)
            put(row, left, self.leaves(ids[row, left], ids[row, follower], left - 1, size))
            held = leader > 0
            if held.any():
                put(row[held], leader[held],
                    self.leaves(ids[row[held], leader[held]], ids[row[held], left[held]], leader[held] - 1, size))
            row = row[tree[row, 1] < NONE]
        live = ids[:, 1:-1]
        flat = live[live >= 0].astype(np.int32).tobytes()
        ends = (4 * np.cumsum((live >= 0).sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one piece, by a tree of its own."""
        size = 1 << max(0, len(piece) - 1).bit_length()
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist() + [-1]
        n, none, pair = len(piece), 1 << 62, self.pair.get
        after, before = list(range(1, n + 2)), list(range(-1, n))
        tree = [none] * (2 * size)
        for i in range(n - 1):
            if (rank := pair(ids[i] << 32 | ids[i + 1])) is not None:
                tree[size + i] = rank * size + i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(position: int, value: int) -> None:
            node = size + position
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        def leaf(left: int, right: int) -> int:
            rank = pair(ids[left] << 32 | ids[right]) if right < n else None
            return none if rank is None else rank * size + left

        while tree[1] < none and size > 1:
            rank, left = divmod(tree[1], size)
            right = after[left]
            ids[left], ids[right] = rank, -1
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
            put(right, none)
            put(left, leaf(left, follower))
            if (leader := before[left]) >= 0:
                put(leader, leaf(leader, left))
        return tuple(i for i in ids if i >= 0)


class Encoder:
    """Encodes and decodes texts; keeps the ids of what it has merged, as packed numbers."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN, kept: int = KEPT) -> None:
        self.vocabulary = vocabulary
        self.matches = regex.compile(pattern).findall
        # Only of this pattern is known where no match goes on.
        self.cuts_at_spaces = pattern == public_tokenizers.PATTERN
        self.kept = kept
        # What is used goes from the older generation to the newer one, the rest goes with it.
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.parts) > self.kept:
            self.older, self.parts = self.parts, {}
        split, new = [], set()
        for text in texts:
            parts, unseen = self._split(text)
            split.append(parts)
            new |= unseen
        self._learn(self._kept_before(new))
        get = self.parts.__getitem__
        return [np.frombuffer(b"".join(map(get, parts)), np.int32) for parts in split]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.token.__getitem__, ids))

    def joined(self, ids) -> str:
        return ",".join(map(self.vocabulary.text.__getitem__, ids))

    def _split(self, text: str) -> tuple[list[str], set[str]]:
        """Parts over whose ends no match goes, each starting at a space, or else the matches
        themselves; those not kept."""
        if not text:
            return [], set()
        if not self.cuts_at_spaces:
            parts = self.matches(text)
        elif "\0" not in text and not LOOSE.search(text):
            parts = text.replace(" ", "\0 ").split("\0")
            if not parts[0]:
                del parts[0]
        else:
            parts = [p for p in JOINT.split(text) if p]
        return parts, set(parts).difference(self.parts)

    def _kept_before(self, new: set[str]) -> set[str]:
        """Take over what the older generation has; returns what it lacks."""
        had = new.intersection(self.older)
        self.parts.update((p, self.older[p]) for p in had)
        return new - had

    def _learn(self, new: set[str]) -> None:
        """Keep the ids of these parts and of the matches in them."""
        if self.cuts_at_spaces:
            found = {p: [p] if p.isalpha() or p[0] == " " and p[1:].isalpha() else self.matches(p) for p in new}
        else:
            found = {p: [p] for p in new}
        ranks, short = self.vocabulary.ranks, []
        matches = set(chain.from_iterable(found.values())).difference(self.parts)
        for match in self._kept_before(matches):
            raw = match.encode()
            if (rank := ranks.get(raw)) is not None:
                self.parts[match] = np.int32(rank).tobytes()
            elif len(raw) <= FOREST_BYTES:
                short.append((match, raw))
            else:
                self.parts[match] = np.array(self.vocabulary.merge_long(raw), np.int32).tobytes()
        merged = self.vocabulary.merge_forest([raw for _, raw in short])
        self.parts.update(zip((m for m, _ in short), merged, strict=True))
        get = self.parts.__getitem__
        for part, matches in found.items():
            if len(matches) > 1:
                self.parts[part] = b"".join(map(get, matches))


@lru_cache(maxsize=1)
def _vocabulary(file: bytes) -> Vocabulary:
    """One vocabulary per Python worker, which serves many tasks."""
    return Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, file.splitlines())})


def _held(spark: SparkSession, path: str):
    """The rank file as a broadcast; its size is that of a tokenizer, not of the data."""
    with open(path, "rb") as f:
        file = f.read()
    if len(file) > 64 << 20:
        raise ValueError(f"{path} is no rank file: {len(file)} bytes")
    return spark.sparkContext.broadcast(file)


def decoded_text(raw: bytes | None) -> str:
    return raw.decode("utf-8", "replace") if raw else ""


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    pattern: str = public_tokenizers.PATTERN,
    row: Column | None = None,
    columns: str = "ids array<int>, n_tokens bigint",
) -> DataFrame:
    """Rows ``(doc, *columns)``, the columns out of ``ids`` (token ids), ``n_tokens``,
    ``ids_sha256`` (of the decimal ids joined by commas), ``decoded`` (bytes decoded
    from the ids) and ``decoded_sha256``."""
    held = _held(docs.sparkSession, path)
    fields = T.StructType.fromDDL(columns)
    names = fields.names

    def start():
        encoder = Encoder(_vocabulary(held.value), pattern)
        make = {
            "n_tokens": len,
            "ids_sha256": lambda ids: hashlib.sha256(encoder.joined(ids).encode()).hexdigest(),
            "decoded": encoder.decode,
            "decoded_sha256": lambda ids: hashlib.sha256(encoder.decode(ids)).hexdigest(),
        }

        def work(texts):
            out = [[] for _ in names]
            for k in range(0, len(texts), BATCH):
                for ids in encoder.encode([decoded_text(t) for t in texts[k : k + BATCH]]):
                    numbers = ids.tolist()
                    for cell, name in zip(out, names, strict=True):
                        # Ids stay packed until the batch is sent.
                        cell.append(ids if name == "ids" else make[name](numbers))
            return out

        return work

    return map_texts(docs, F.col(text), start, fields, row)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with the text of the token ids; null ids give null. Bytes that are no
    UTF-8, as a cut in the middle of a character leaves, become U+FFFD."""
    held = _held(df.sparkSession, path)

    @F.pandas_udf("string")
    def decoded(column):
        token = Encoder(_vocabulary(held.value)).decode
        return column.map(lambda x: None if x is None else token(list(x)).decode("utf-8", "replace"))

    return df.withColumn(out, decoded(F.col(ids)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    docs = table(spark, sf_dir, "documents")
    done = encode(docs, public_tokenizers.path(RANKS), row=F.col("doc_id"), columns=columns)
    return done.select(F.col(ROW).alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
