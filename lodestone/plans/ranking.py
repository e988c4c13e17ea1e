"""Consensus ranking and benchmark queries over parts and documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.draws import draw_sql
from ..operators import ranking as ops
from ..operators.order import numbered
from .registry import query, table

SAMPLES, SEED = 200, 42
#: What each channel ranks: sizes up to, prices from, quantities returned from; all else it leaves unranked.
SIZE, PRICE, SOLD = 40, 975, 315

_RANKS = f"""a AS (SELECT 'size' AS channel, p_partkey AS key, row_number() OVER (ORDER BY p_size, p_partkey) AS position FROM part WHERE p_size <= {SIZE}),
b AS (SELECT 'price', p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) FROM part WHERE p_retailprice >= {PRICE}),
c AS (SELECT 'sold', l_partkey, row_number() OVER (ORDER BY sum(l_quantity) DESC, l_partkey) FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey HAVING sum(l_quantity) >= {SOLD}),
r AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c),
t AS (SELECT channel, count(*) AS total FROM r GROUP BY channel), n AS (SELECT channel, key, min(position) / any_value(total) AS r FROM r JOIN t USING (channel) GROUP BY ALL)"""
_RRA = f"""{_RANKS}, o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY r, channel) AS i FROM n),
p AS (SELECT key, count(*) AS n_support, min(CASE WHEN r >= 1 THEN 1 WHEN i = 1 THEN 1 - (1 - r) ** 3 WHEN i = 2 THEN 3 * r ** 2 * (1 - r) + r ** 3 ELSE r ** 3 END) AS p FROM o GROUP BY key),
br AS (SELECT channel, count(DISTINCT key) / (SELECT count(DISTINCT key) FROM n) > 0.5 AS broad FROM n GROUP BY channel),
d AS (SELECT key, count(*) FILTER (WHERE NOT broad) AS n_discriminating FROM n JOIN br USING (channel) GROUP BY key),
agg AS (SELECT key, least(1, 3 * p) AS score, p, n_support, n_discriminating, CASE WHEN n_support < 2 THEN 'none' WHEN n_discriminating >= 2 THEN 'discriminating' WHEN n_discriminating = 1 THEN 'mixed' ELSE 'broad_only' END AS convergence FROM p JOIN d USING (key))"""


def _rankings(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    sold = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).filter(F.col("q") >= SOLD)

    def channel(rows, name, key, value):
        return rows.select(F.lit(name).alias("channel"), F.col(key).alias("key"), value.cast("double").alias("value"))

    rows = (
        channel(part.filter(F.col("p_size") <= SIZE), "size", "p_partkey", F.col("p_size"))
        .unionAll(channel(part.filter(F.col("p_retailprice") >= PRICE), "price", "p_partkey", -F.col("p_retailprice")))
        .unionAll(channel(sold, "sold", "l_partkey", -F.col("q")))
    )
    return numbered(rows, ["value", "key"], by=["channel"])


@query(f"WITH {_RRA} SELECT key, round(score, 9) AS score, round(p, 9) AS p, n_support, convergence FROM agg")
def rra(spark, sf_dir):
    out = ops.aggregate(_rankings(spark, sf_dir), 3)
    return out.select("key", F.round("score", 9).alias("score"), F.round("p", 9).alias("p"), "n_support", "convergence")


@query(f"WITH {_RRA} SELECT convergence, count(*) AS n FROM agg GROUP BY convergence")
def convergence(spark, sf_dir):
    return ops.aggregate(_rankings(spark, sf_dir), 3).groupBy("convergence").agg(F.count("*").alias("n"))


@query(f"""WITH {_RRA} SELECT key, row_number() OVER (ORDER BY s, o, n_support DESC, key) AS rank FROM (SELECT *, round(score, 9) AS s,
 CASE convergence WHEN 'discriminating' THEN 0 WHEN 'mixed' THEN 1 WHEN 'broad_only' THEN 2 ELSE 3 END AS o FROM agg) ORDER BY 2 LIMIT 100""")
def consensus_order(spark, sf_dir):
    order = F.expr("CASE convergence WHEN 'discriminating' THEN 0 WHEN 'mixed' THEN 1 WHEN 'broad_only' THEN 2 ELSE 3 END")
    by = [F.round("score", 9), order, F.desc("n_support"), F.col("key")]
    top = ops.aggregate(_rankings(spark, sf_dir), 3).orderBy(*by).limit(100)
    return top.select("key", F.row_number().over(Window.orderBy(*by)).cast("bigint").alias("rank"))


@query(f"WITH {_RANKS} SELECT channel, count(DISTINCT key) AS n_keys, count(DISTINCT key) / (SELECT count(DISTINCT key) FROM n) > 0.5 AS broad FROM n GROUP BY channel")
def broad_channels(spark, sf_dir):
    ranks = ops.normalised_ranks(_rankings(spark, sf_dir))
    return ops.broad_channels(ranks).join(ranks.groupBy("channel").agg(F.countDistinct("key").alias("n_keys")), "channel").select("channel", "n_keys", "broad")


_BENCH = """r AS (SELECT doc_id, quality = 1 AS is_positive, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS position FROM (SELECT d.doc_id, n_chars, max(quality) AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL)),
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_positive) AS np FROM r),
f AS (SELECT idx, ((n - np) - (position - idx)) / nullif(n - np, 0) AS fraction, np AS m FROM (SELECT position, row_number() OVER (ORDER BY position) AS idx FROM r WHERE is_positive), tot)"""


def _ranked(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    q = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return numbered(d.join(q, "doc_id").select("doc_id", "n_chars", (F.col("quality") == 1).alias("is_positive")), [F.desc("n_chars"), "doc_id"])


@query(f"WITH {_BENCH} SELECT round(avg(fraction), 6) AS auroc, count(*) AS n_positives FROM f")
def auroc(spark, sf_dir):
    return ops.auroc(_ranked(spark, sf_dir)).select(F.round("auroc", 6).alias("auroc"), "n_positives")


@query(f"WITH {_BENCH} SELECT CAST(k AS BIGINT) AS k, count(*) FILTER (WHERE is_positive AND position <= k) AS found, count(*) FILTER (WHERE is_positive) AS total FROM r, (VALUES (10), (50), (100), (500)) v(k) GROUP BY k")
def enrichment_at_k(spark, sf_dir):
    return ops.enrichment(_ranked(spark, sf_dir), [10, 50, 100, 500])


@query(f"""WITH {_BENCH}, d AS (SELECT sample, {draw_sql(SEED, 'sample', 'idx')} % m + 1 AS pick FROM f, range({SAMPLES}) t(sample)),
s AS (SELECT sample, avg(fraction) AS a FROM d JOIN f ON f.idx = d.pick GROUP BY sample), l AS (SELECT list_sort(list(a)) AS a FROM s)
SELECT round(a[{int(0.025 * (SAMPLES - 1)) + 1}], 4) AS lo, round(a[{int(0.975 * (SAMPLES - 1)) + 1}], 4) AS hi, (SELECT count(*) FROM f) AS n_positives FROM l""")
def bootstrap_ci(spark, sf_dir):
    return ops.bootstrap(_ranked(spark, sf_dir), SAMPLES, SEED)
