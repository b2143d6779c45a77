from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm import bpe as m

RANKS = m.read_ranks(public_tokenizers.path(m.RANKS))
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return m.Encoder(m.Vocabulary(RANKS))


ALPHABET = "abeéèñß  \n\t'sdlrtve.,!?123\x00\x1c\x85\xa0　漢😀²½_-<|endoftext|>"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet=ALPHABET, max_size=80)))
def test_same_ids_as_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    encoder = test_same_ids_as_the_library.encoder
    ids = encoder.encode([text])[0].tolist()
    assert ids == PLAIN.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


test_same_ids_as_the_library.encoder = m.Encoder(m.Vocabulary(RANKS), kept=200)


@pytest.mark.parametrize("text", ["a" * 5000, "the" * 3000, "ab" * 999 + "é" * 999, " " * 4000, "x" * 64, "x" * 65, "漢字" * 700])
def test_long_matches(encoder, text):
    assert encoder.encode([text])[0].tolist() == PLAIN.encode_ordinary(text)


def test_both_trees_agree(encoder):
    rng = random.Random(0)
    pieces = [bytes(rng.choices(b"abcdething \xc3\xa9", k=rng.randrange(1, 64))) for _ in range(400)]
    merged = encoder.vocabulary.merge_forest(pieces)
    for piece, ids in zip(pieces, merged, strict=True):
        long = encoder.vocabulary.merge_long(piece)
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == list(long)


def test_query_equals_the_library(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in m.query(spark, sf_dir).collect()}
    for r in documents.collect():
        ids = PLAIN.encode_ordinary(r["text"])
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_awkward_rows_and_round_trip(spark):
    texts = [None, "", " ", "a b", "a b", "word " * 100_000, "\0 \0", "é" * 3]
    rows = [(i % 4, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    path = public_tokenizers.path(m.RANKS)
    made = m.encode(df, path)
    assert [r["n_tokens"] for r in made.collect()][:2] == [0, 0]
    back = m.decode(made.select(F.col("doc.text").alias("was"), "ids"), path).collect()
    assert all(r["text"] == (r["was"] or "") for r in back)
    assert m.encode(df.limit(0), path).count() == 0


def test_invalid_utf8(spark):
    df = spark.sql("select cast(x'61ff62' as string) as text, 1 as doc_id")
    row = m.encode(df, public_tokenizers.path(m.RANKS), row=F.col("doc_id")).collect()[0]
    assert row["ids"] == PLAIN.encode_ordinary("a�b")


def test_rank_files_of_any_size_are_not_broadcast(spark, tmp_path):
    with open(tmp_path / "big", "wb") as f:
        f.truncate((64 << 20) + 1)
    with pytest.raises(ValueError, match="no rank file"):
        m._held(spark, str(tmp_path / "big"))


def test_runs_of_spaces_do_not_depend_on_earlier_texts():
    ranks = RANKS | {b"  ": len(RANKS)}
    plain = tiktoken.Encoding("spaces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = m.Encoder(m.Vocabulary(ranks))
    for text in ("x ", "a b", "a   b", "a\n   b  ", "  "):
        assert encoder.encode([text])[0].tolist() == plain.encode_ordinary(text)


@pytest.mark.parametrize("pattern", [r"\p{L}{1,3}|\s+|[^\s\p{L}]+", r"[^\r\n]+|[\r\n]+", r"\S+\s?|\s+"])
def test_any_pattern_is_split_by_itself(pattern):
    plain = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    encoder = m.Encoder(m.Vocabulary(RANKS), pattern, kept=3)
    for text in ("international business", "a b  c\n d", "don't  stop", "", " ", "x" * 100 + " \n\n y"):
        assert encoder.encode([text])[0].tolist() == plain.encode_ordinary(text)


def test_generations_of_the_cache():
    """What is in use stays, what isn't goes with its generation, and the ids are the same."""
    vocabulary = m.Vocabulary(RANKS)
    encoder = m.Encoder(vocabulary, kept=5)
    for n in range(30):
        text = f"always here once{chr(97 + n % 10) * (1 + n // 10)}"
        assert encoder.encode([text])[0].tolist() == PLAIN.encode_ordinary(text)
        assert " here" in encoder.parts
    assert len(encoder.parts) + len(encoder.older) < 20
    assert " oncea" not in encoder.parts | encoder.older
