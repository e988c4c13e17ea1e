"""One query per corpus operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, divergence, exact_dedup, langid, licenses, mixing, quality, sharding, site_tree, superminhash, toxicity, warc
from .common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(VOCABULARY)
    return bpe.round_trip(table(spark, sf_dir, "documents"), "text", "doc_id", ranks, public_tokenizers.PATTERN)


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(spark, sf_dir, "pages"))


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.components(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op8_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge(docs, forest)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    held_out = ~toxicity.learned_from(F.col("doc_id"))
    return toxicity.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_site_style_tree,
        op3_superminhash,
        op4_license_scan,
        op5_exact_dedup,
        op6_warc_salvage,
        op7_compression_langid,
        op8_isolation_forest,
        op9_curriculum_mix,
        op10_feistel_shards,
        op11_factorization_toxicity,
        op12_divergence_audit,
        op13_collocations,
    )
}

#: The other operators rest on models, parsers or merges that SQL does not have.
ORACLES: dict[str, str] = {
    "op2_site_style_tree": site_tree.SQL,
    "op3_superminhash": superminhash.SQL,
    "op4_license_scan": licenses.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_warc_salvage": warc.SQL,
    "op9_curriculum_mix": mixing.SQL,
    "op10_feistel_shards": sharding.SQL,
    "op12_divergence_audit": divergence.SQL,
    "op13_collocations": collocations.SQL,
}
