"""What leaves the engine for readers: contracts, artifacts, claims, pages, and the tables behind figures."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lexical import html_escape
from .registry import QUERIES, query


def field_contract(table: DataFrame, wanted: list[str], done: bool) -> dict[str, list[str]]:
    """Fields that a table must have, by whether they are there and the step that fills them is done."""
    have = set(table.columns) if done else set()
    return {"satisfied": sorted(have & set(wanted)), "outstanding": sorted(set(wanted) - have)}


def artifacts(folder: str, status: str = "status.json") -> list[str]:
    """Tables of a layer: those its status record calls complete; without a record what the folder holds."""
    path = os.path.join(folder, status)
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            return sorted(n for n, s in json.load(f).items() if s.get("status") == "complete")
    found = sorted(n for n in os.listdir(folder) if not n.startswith((".", "_")))
    if not found:
        raise ValueError(f"{folder} is empty")
    return found


def claims(spark: SparkSession, said: dict[str, tuple[DataFrame, str, float]], off: float = 1e-9) -> DataFrame:
    """``claim, said, found, holds``: a documented number against the one value that a table's expression gives."""
    rows = [(name, float(value), table.agg(F.expr(expr).cast("double")).first()[0]) for name, (table, expr, value) in said.items()]
    held = F.coalesce(F.abs(F.col("said") - F.col("found")) <= off, F.lit(False))
    return spark.createDataFrame(rows, "claim string, said double, found double").withColumn("holds", held)


def formatted(table: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Numbers as text with a fixed number of places; NULL stays NULL."""
    return table.withColumns({c: F.when(F.col(c).isNotNull(), F.format_string(f"%.{n}f", F.col(c).cast("double"))) for c, n in digits.items()})


def html_table(table: DataFrame, order: list, most: int = 1000) -> str:
    """A small table as HTML, every cell escaped, NULL an empty cell; a longer one is an error, not cut."""
    text = [F.coalesce(html_escape(F.col(f"`{f.name}`").cast(T.StringType())), F.lit("")).alias(f.name) for f in table.schema.fields]
    rows = table.orderBy(*order).select(text).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the table has more than {most} rows")
    head = "".join(f"<th>{n}</th>" for n in table.columns)
    return f"<table><tr>{head}</tr>" + "".join("<tr>" + "".join(f"<td>{v}</td>" for v in r) + "</tr>" for r in rows) + "</table>"


@query("""WITH p AS (SELECT p_partkey AS key, CASE WHEN p_size <= 40 THEN row_number() OVER (PARTITION BY p_size <= 40 ORDER BY p_size, p_partkey) END AS rank_size,
  CASE WHEN p_retailprice > 975 THEN row_number() OVER (PARTITION BY p_retailprice > 975 ORDER BY p_retailprice DESC, p_partkey) END AS rank_price FROM part)
SELECT 'size' AS channel, key, rank_size AS position FROM p WHERE rank_size IS NOT NULL UNION ALL SELECT 'price', key, rank_price FROM p WHERE rank_price IS NOT NULL""")
def channel_rankings(spark, sf_dir):
    """Each channel's own ranking out of a table of ``rank_`` columns: what it did not rank is not in it."""
    from ..operators.order import numbered
    from .registry import table

    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_size", "p_retailprice")
    size = numbered(p.filter("p_size <= 40"), ["p_size", "key"], name="rank_size").select("key", "rank_size")
    price = numbered(p.filter("p_retailprice > 975"), [F.desc("p_retailprice"), "key"], name="rank_price").select("key", "rank_price")
    return rankings(size.join(price, "key", "full"), ["size", "price"])


def rankings(wide: DataFrame, channels: list[str]) -> DataFrame:
    """``channel, key, position`` of (key, rank_<channel>, ...)."""
    long = wide.select("key", F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"rank_{c}").cast("bigint").alias("position")) for c in channels])).alias("x"))
    return long.select("x.channel", "key", "x.position").filter("position IS NOT NULL")


@query("""WITH t AS (SELECT CASE WHEN p_partkey % 4 > 0 AND p_size % 4 < 3 THEN 'supported' ELSE 'hypothesis' END AS tier, p_size % 4 AS grade, p_retailprice > 975 AS supported FROM part)
SELECT 'tier' AS figure, tier AS label, count(*) AS n FROM t GROUP BY tier UNION ALL SELECT 'grade', CAST(grade AS VARCHAR), count(*) FROM t GROUP BY grade
UNION ALL SELECT 'supported', CAST(supported AS VARCHAR), count(*) FROM t GROUP BY supported""")
def figure_inputs(spark, sf_dir):
    """Counts behind the figures in one pass: by tier, by grade, by support."""
    from .registry import table

    t = table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_partkey % 4 > 0 AND p_size % 4 < 3 THEN 'supported' ELSE 'hypothesis' END AS tier", "CAST(p_size % 4 AS STRING) AS grade", "CAST(p_retailprice > 975 AS STRING) AS supported"
    )
    long = t.select(F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).alias("label")) for c in t.columns])).alias("x"))
    return long.groupBy("x.figure", "x.label").agg(F.count("*").alias("n"))


def figures(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """Registered queries that a report draws, by name; an unknown one is an error."""
    unknown = sorted(set(names) - set(QUERIES))
    if unknown:
        raise ValueError(f"no query is named {unknown}")
    return {n: QUERIES[n](spark, sf_dir) for n in names}
