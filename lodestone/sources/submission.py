"""A ranked submission: its rows built, its file and every broken rule of every row found."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.order import numbered


def violations(rows: DataFrame) -> DataFrame:
    """``row, code`` for (row, contig, pos, ref, alt, epcr), all read as text."""
    n = numbered(rows.withColumn("e", F.col("epcr").try_cast("double")), ["row"], name="place")
    n = n.join(n.select((F.col("place") + 1).alias("place"), F.col("e").alias("before")), "place", "left")
    n = n.withColumn("nth", F.row_number().over(Window.partitionBy("contig", "pos", "ref", "alt").orderBy("row")))
    rules = [
        ("contig", ~F.col("contig").rlike("^chr([1-9]|1[0-9]|2[0-2]|X|Y|MT)$")),
        ("position", F.col("pos").try_cast("bigint").isNull()),
        ("bases", ~F.col("ref").rlike("^[ACGT]+$") | ~F.col("alt").rlike("^[ACGT]+$")),
        ("same", F.col("ref") == F.col("alt")),
        ("range", ~((F.col("e") > 0) & (F.col("e") <= 1))),
        ("order", F.col("e") > F.col("before")),
        ("duplicate", F.col("nth") > 1),
    ]
    return n.select("row", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules]))).alias("code"))


def file_violations(spark: SparkSession, path: str, header: list[str], most: int) -> DataFrame:
    """``row, code`` for what is wrong with the file as such; rows count from 1, 0 is the whole file.

    A submission is a small file by its rules, so it is read in one piece.
    """
    held = spark.read.format("binaryFile").load(path).first()  # none if it is empty
    raw = bytes(held["content"]) if held else b""
    found: list[tuple[int, str]] = []
    if raw.startswith(b"\xef\xbb\xbf"):
        found.append((0, "byte_order_mark"))
        raw = raw[3:]
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        text = None
        found.append((0, "encoding"))
    rows = [] if text is None else list(csv.reader(io.StringIO(text)))
    filled = [(n, r) for n, r in enumerate(rows[1:], 1) if any(c.strip() for c in r)]
    if text is not None and not text.strip():
        found.append((0, "empty"))
    elif text is not None:
        names = rows[0]
        if names != header:
            kinds = (("header_missing", set(header) - set(names)), ("header_unexpected", set(names) - set(header)))
            found += [(0, k) for k, cols in kinds if cols] or [(0, "header_order")]
        if not filled:
            found.append((0, "no_rows"))
        if len(filled) > most:
            found.append((0, "too_many_rows"))
        found += [(n, "width") for n, r in filled if len(r) != len(header)]
        ids = {r[0].strip() for _, r in filled if r}
        if len(ids - {""}) > 1:
            found.append((0, "several_ids"))
        found += [(n, "no_id") for n, r in filled if not r[0].strip()]
    return spark.createDataFrame(found, "row long, code string")


def allele_violations(rows: DataFrame, required: bool = True) -> DataFrame:
    """``row, code`` of alleles (row, contig, pos, ref, alt): none where one is due, or one that is half filled."""
    parts = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "" for c in ("contig", "pos", "ref", "alt")]
    n = sum((p.cast("int") for p in parts[1:]), parts[0].cast("int"))
    prefix = parts[0] & ~F.col("contig").startswith("chr")
    rules = [("missing_allele", (n == 0) & F.lit(required)), ("partly_filled", (n > 0) & (n < 4)), ("prefix", prefix), ("not_positive", F.col("pos").try_cast("bigint") <= 0)]
    return rows.select("row", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules]))).alias("code"))


def ranked_rows(candidates: DataFrame, most: int = 2) -> DataFrame:
    """The rows to submit of (gene, a_id, b_id, epcr): at most ``most``, best first; more than one gene is an error."""
    genes = candidates.select("gene").distinct().limit(2).count()
    if genes != 1:
        raise ValueError("a submission is about exactly one gene")
    top = candidates.orderBy(F.desc("epcr"), "a_id", "b_id").limit(most)
    return top.select(F.row_number().over(Window.orderBy(F.desc("epcr"), "a_id", "b_id")).cast("bigint").alias("row"), *candidates.columns)
