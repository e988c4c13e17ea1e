"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import cut as written
from ..operators.tables import discard  # noqa: F401

#: Words are runs of anything but ASCII space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is absent on one machine (tests) a temporary folder is set,
    once for the session; on a cluster that is an error.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    held = sc._jsc.sc().getCheckpointDir()
    if not where:
        if held.isDefined():
            return held.get()
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: executors share no folder")
        where = tempfile.mkdtemp(prefix="lodestone-ckpt-")
    if not held.isDefined():
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage of ``df`` with a checkpoint in the shared folder; its partitioning stays known."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back: for loops.

    A checkpoint hands on its plan's size estimate, which squares with every
    self-join of a loop; a table has its real size.  ``discard`` deletes one that nothing reads any more.
    """
    shared_dir(df.sparkSession)
    return written(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, inside an interpreted lambda."""
    return F.transform(F.array(value), body)[0]


def draw(*parts: Column) -> Column:
    """A stateless draw of 60 bits from the md5 of the given columns; nulls take part."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def draw_sql(*parts: str) -> str:
    """The same draw in the oracle's SQL."""
    key = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts)
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT)"


#: Bytes of UTF-8 in which A-Z are lower-cased and what is no part of a term is a space.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_bytes(text) -> list[bytes]:
    """The terms (runs of letters A-Z and of all beyond ASCII) of a text in UTF-8; none of a null."""
    return bytes(text).translate(_TERMS).split() if text is not None else []


def count_words(text: Column) -> Column:
    """Number of words of a text; null counts as none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
