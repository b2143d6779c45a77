"""From raw documents to token ids: each stage works on what its predecessor kept, is
written to the shared folder as Parquet and read again by the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import bpe, decontaminate, language_id, ngram_join, toxicity
from ebbtide.llm.shared import ROW, discard, finished, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, learnt from the labels of these documents."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a posterior of at least 0.5."""
    return language_id.with_known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every group of linked documents."""
    return ngram_join.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of whole texts, and digests of the ids and of what they decode to."""
    columns = "ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    encoded = bpe.encode(docs, public_tokenizers.path(bpe.RANKS), row=F.col("doc_id"), columns=columns)
    return encoded.select(F.col(ROW).alias("doc_id"), "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

# Trees, a fitted language model and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage stores on the way goes with its end, and
    its result once the next one's is written. The last result stays."""
    docs, folders = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        before = folders
        docs, folders = finished(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        discard(spark, before)
    return docs
