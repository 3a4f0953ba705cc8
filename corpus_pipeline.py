"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from eqlake.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from eqlake.llm.common import table
from eqlake.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per distinct text (A-Z lower-cased): the one with the largest doc_id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group linked by a similarity of 0.8 or more on five-word shingles."""
    return near_dedup.near_dedup(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per time that the mix of sources takes them."""
    return mixing.draw_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the digests of the token ids of every drawn document."""
    return bpe.digest(docs.select("doc_id", "source", "text"), *bpe.multi_ranks())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: The classifier is trained by gradient descent, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
