"""Stages that turn the documents table into a tokenized training mix.

Each stage works on all that its predecessor kept and returns the columns of
documents; the last returns token counts and the digests of its round trip.

Columns beside ``doc_id``, ``text``, ``lang`` and ``source`` are carried along
unread, whatever their names.  Empty tables pass every stage as empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import bpe, exact_dedup, langid, mixing, superminhash
from lodestone.llm.common import cut
from lodestone.llm.queries import VOCABULARY


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (null and empty texts among them) or with too narrow a margin.

    Rows that repeat are judged alike; a null ``lang`` teaches nothing and a null
    ``doc_id`` may.
    """
    return langid.drop_rejected(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of smallest id of every group of equal texts, null as empty; a null id only where all are null.

    Rows that repeat text and id leave one.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of every component of near copies.

    Rows of a null id, and texts without words, are linked with nothing and stay;
    rows that share an id stay or go together.
    """
    return superminhash.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents by their sources' targets, in training order.

    A null source is one of its own; a document without words stands for itself,
    as often as its source is taken whole.
    """
    return mixing.curriculum(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text: ``doc_id``, ``n_tokens`` and both digests; a null text has no tokens."""
    ranks = bpe.read_ranks(VOCABULARY)
    return bpe.round_trip(docs, "text", "doc_id", ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("byte BPE", tokenize),
]
#: SQL expresses neither compression nor SuperMinHash nor merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)  # a lost executor costs a stage, not the run
    return docs
