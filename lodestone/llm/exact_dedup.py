"""Exact deduplication by 128-bit content hash, bytes compared inside groups.

Rows are grouped by the hash and the normalised bytes together: the aggregate
compares key bytes whenever hashes agree, so texts that merely share a hash stay
apart, and copies collapse in the map tasks before anything is shuffled, however
large their group.  Each text is shuffled once at most.  Rows then find their
group by the hash and a second digest; a pair of groups that these two cannot
tell apart stops the job instead of merging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run of white space that is not a single space already.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per distinct text: ``h``, ``sha``, ``keep_id``, ``group_size``."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text)).alias("norm"))
    rows = rows.select("id", "norm", F.md5("norm").alias("h"))
    distinct = rows.groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    keyed = distinct.select("h", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    clash = F.raise_error(F.lit("two texts share both digests")).cast("bigint")
    return (
        keyed.groupBy("h", "sha")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("texts"))
        .select("h", "sha", "keep_id", F.when(F.col("texts") > 1, clash).otherwise(F.col("group_size")).alias("group_size"))
    )


def mark(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document, dropped ones too.

    ``keep_id`` is the smallest id of the group of equal texts and ``kept`` is
    true for the row that has it.  Null texts count as empty ones and so form
    one group.  A row whose id is null is kept only if all ids of its group are
    null; rows that repeat the smallest id are all kept.  Other columns of the
    input are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    rows = rows.select("doc_id", F.md5("norm").alias("h"), F.sha2("norm", 256).alias("sha"))
    # A key of its own, not the grouped columns: both sides are dealt anew for the
    # join, and Spark may then split the rows of a large group over many tasks.
    rows = rows.withColumn("key", F.concat("h", "sha"))
    found = rows.join(groups(docs, text, id_col).select(F.concat("h", "sha").alias("key"), "keep_id", "group_size"), "key")
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the first row of every group of equal texts, all columns kept.

    Rows that repeat both text and id leave one row.
    """
    kept = groups(docs, text, id_col).select(F.col("keep_id").alias("__keep_id"), F.col("h").alias("__h"), F.col("sha").alias("__sha"))
    norm = normalised(F.col(text))
    rows = docs.withColumn("__h", F.md5(norm)).withColumn("__sha", F.sha2(norm, 256))
    same = (rows["__h"] == kept["__h"]) & (rows["__sha"] == kept["__sha"]) & rows[id_col].eqNullSafe(kept["__keep_id"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["__h", "__sha", id_col]).drop("__h", "__sha")


SQL = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
