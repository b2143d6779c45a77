"""The stages of the pipeline, each against a check of its own input."""

from __future__ import annotations

import public_tokenizers
import pytest
import tiktoken
from test_decontaminate import brute as brute_hits
from test_ngram_join import brute as brute_groups

import corpus_pipeline
from ebbtide.llm import bpe, toxicity
from ebbtide.llm.shared import staged


@pytest.fixture(scope="module")
def steps(spark, sf_dir, documents):
    out = [documents]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_dir), name).cache())
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(steps, documents):
    assert all(df.columns == documents.columns for df in steps[:-1])
    assert all(df.schema == documents.schema for df in steps[1:-1])


def test_toxic_documents_go(spark, sf_dir, steps):
    score = toxicity.fitted(steps[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    from pyspark.sql import functions as F

    low = {r["doc"] for r in score(steps[0], row=F.col("doc_id")).where("score < 0.5").collect()}
    assert set(texts(steps[1])) == low
    clean = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 0")
    assert steps[1].join(clean, "doc_id").count() >= 0.99 * clean.count()


def test_known_languages_stay(steps):
    assert set(texts(steps[2])) == set(texts(steps[1]))


def test_one_of_each_group(steps):
    rows = list(texts(steps[2]).items())
    assert set(texts(steps[3])) == {c for _, _, c in brute_groups(rows)}


def test_contaminated_documents_go(spark, sf_dir, steps):
    before = texts(steps[3])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = dict(zip(before, brute_hits(list(before.values()), items), strict=True))
    assert set(texts(steps[4])) == {i for i, (n, h, _) in hits.items() if not (h and 20 * h >= n)}


def test_tokens(steps):
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = texts(steps[4])
    got = {r["doc_id"]: r["ids"] for r in steps[5].collect()}
    assert got == {i: plain.encode_ordinary(t) for i, t in own.items()}


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
