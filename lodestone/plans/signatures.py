"""Signature queries: embeddings as score vectors, their labels as groups and queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import signatures as ops
from .registry import query, table

SIZE, DEPTHS = 8, [1, 5, 10, 25]

_LONG = """sg AS (SELECT vec_id AS sig, label AS grp, embedding AS z FROM embeddings),
lg AS (SELECT sig, grp, CAST(unnest(z) AS DOUBLE) AS z, unnest(range(len(z))) AS gene FROM sg),
rk AS (SELECT *, row_number() OVER (PARTITION BY sig ORDER BY z DESC, gene) - 1 AS pos, count(*) OVER (PARTITION BY sig) AS n FROM lg)"""
_MEANS = "ev AS (SELECT label AS query, CAST(unnest(embedding) AS DOUBLE) AS z, unnest(range(len(embedding))) AS gene FROM embeddings), mn AS (SELECT query, gene, avg(z) AS z FROM ev GROUP BY ALL)"
_TAILS = f"{_MEANS}, th AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY z DESC, gene) AS h, row_number() OVER (PARTITION BY query ORDER BY z, gene DESC) AS l FROM mn), tl AS (SELECT query, gene, CASE WHEN h <= {SIZE} THEN 'up' ELSE 'down' END AS tail FROM th WHERE h <= {SIZE} OR l <= {SIZE})"


def _es(tail: str) -> str:
    return f"""h_{tail} AS (SELECT q.query, rk.*, t.gene IS NOT NULL AS hit FROM rk CROSS JOIN (SELECT DISTINCT query FROM tl) q LEFT JOIN tl t ON t.query = q.query AND t.gene = rk.gene AND t.tail = '{tail}'),
d_{tail} AS (SELECT query, sig, grp, pos, sum(CASE WHEN hit THEN abs(z) ELSE 0 END) OVER (PARTITION BY query, sig) AS total,
  round(sum(CASE WHEN hit THEN abs(z) ELSE 0 END) OVER w / nullif(sum(CASE WHEN hit THEN abs(z) ELSE 0 END) OVER (PARTITION BY query, sig), 0) - sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER w / (n - {SIZE}), 12) AS dev
  FROM h_{tail} WINDOW w AS (PARTITION BY query, sig ORDER BY pos ROWS UNBOUNDED PRECEDING)),
e_{tail} AS (SELECT query, sig, grp, arg_max(dev, {{'a': abs(dev), 'p': -pos}}) AS es FROM d_{tail} GROUP BY ALL)"""


_WTCS = f"{_LONG}, {_TAILS}, {_es('up')}, {_es('down')}, wt AS (SELECT query, sig, grp, u.es AS es_up, d.es AS es_down, CASE WHEN sign(u.es) = sign(d.es) THEN 0 ELSE (u.es - d.es) / 2 END AS wtcs FROM e_up u JOIN e_down d USING (query, sig, grp))"
_NCS = f"{_WTCS}, nc AS (SELECT *, CASE WHEN wtcs = 0 THEN 0 ELSE wtcs / avg(abs(wtcs)) OVER (PARTITION BY query, grp, sign(wtcs)) END AS ncs FROM wt)"


def _signatures(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sig"), F.col("label").alias("grp"), F.col("embedding").alias("z"))


def _tails(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    return ops.query_tails(ops.consensus(e, "label"), SIZE)


def _scores(spark, sf_dir):
    return ops.connectivity(ops.ranked(_signatures(spark, sf_dir)), _tails(spark, sf_dir))


@query(f"WITH {_TAILS} SELECT query, CAST(gene AS BIGINT) AS gene, tail FROM tl")
def query_tails(spark, sf_dir):
    return _tails(spark, sf_dir).withColumn("gene", F.col("gene").cast("bigint"))


@query(f"WITH {_WTCS} SELECT query, sig, round(es_up, 6) AS es_up, round(es_down, 6) AS es_down, round(wtcs, 6) AS wtcs FROM wt")
def wtcs(spark, sf_dir):
    return _scores(spark, sf_dir).select("query", "sig", *[F.round(c, 6).alias(c) for c in ("es_up", "es_down", "wtcs")])


@query(f"WITH {_NCS} SELECT query, sig, round(ncs, 6) AS ncs FROM nc")
def ncs(spark, sf_dir):
    return ops.normalise(_scores(spark, sf_dir)).select("query", "sig", F.round("ncs", 6).alias("ncs"))


_MAXQ = f"{_NCS}, mq AS (SELECT query, grp AS key, CASE WHEN abs(quantile_cont(ncs, 0.67)) >= abs(quantile_cont(ncs, 0.33)) THEN quantile_cont(ncs, 0.67) ELSE quantile_cont(ncs, 0.33) END AS score FROM nc GROUP BY ALL)"


def _quantiles(spark, sf_dir):
    n = ops.normalise(_scores(spark, sf_dir)).withColumn("ncs", F.col("ncs").cast("double"))
    return ops.max_quantile(n.withColumnRenamed("grp", "key"), "ncs", ["query", "key"])


@query(f"WITH {_MAXQ} SELECT query, key, round(score, 6) AS score FROM mq")
def max_quantile(spark, sf_dir):
    return _quantiles(spark, sf_dir).withColumn("score", F.round("score", 6))


_LADDER = f"{_MAXQ}, rung AS (SELECT query, row_number() OVER (PARTITION BY query ORDER BY round(score, 9), key) AS depth, round(score, 9) AS score FROM mq)"


def _rungs(spark, sf_dir):
    return ops.ladder(_quantiles(spark, sf_dir).withColumn("score", F.round("score", 9)), DEPTHS)


@query(f"WITH {_LADDER} SELECT query, depth, score FROM rung WHERE depth IN (1, 5, 10, 25)")
def depth_ladder(spark, sf_dir):
    return _rungs(spark, sf_dir)


@query(f"""WITH {_LADDER} SELECT depth, round((count(*) FILTER (WHERE n.score <= o.score) + 1) / (count(*) + 1), 6) AS p, (count(*) FILTER (WHERE n.score <= o.score) + 1) / (count(*) + 1) <= 0.3 AS passes
FROM rung n JOIN rung o USING (depth) WHERE o.query = 0 AND n.query <> 0 AND depth IN (1, 5, 10, 25) GROUP BY depth""")
def depth_null(spark, sf_dir):
    return ops.passing_depth(_rungs(spark, sf_dir), "0", 0.3).withColumn("p", F.round("p", 6))


@query(f"""WITH {_MEANS}, ax AS (SELECT gene, avg(z) - avg(avg(z)) OVER () AS a FROM mn GROUP BY gene), ce AS (SELECT query, gene, z - avg(z) OVER (PARTITION BY query) AS c FROM mn),
j AS (SELECT query, gene, c, a, sum(c * a) OVER w / sum(a * a) OVER w AS along, corr(c, a) OVER w AS r_before FROM ce JOIN ax USING (gene) WINDOW w AS (PARTITION BY query))
SELECT query, round(any_value(r_before), 6) AS r_before, round(abs(corr(c - along * a, a)), 6) AS r_after, round(sqrt(sum((c - along * a) ** 2)), 6) AS norm FROM j GROUP BY query""")
def deflate_axis(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    means = ops.consensus(e, "label")
    axis = means.groupBy("gene").agg(F.avg("z").alias("z"))
    d = ops.deflate(means, axis)
    return d.groupBy("query").agg(
        F.round(F.first("r_before"), 6).alias("r_before"), F.round(F.abs(F.corr("z", "a")), 6).alias("r_after"), F.round(F.sqrt(F.sum(F.col("z") * F.col("z"))), 6).alias("norm")
    )


@query("""WITH s AS (SELECT vec_id AS sig, CAST(unnest(embedding) AS DOUBLE) AS z, unnest(range(len(embedding))) AS gene, label AS grp FROM embeddings),
r AS (SELECT sig, grp, gene, rank() OVER (PARTITION BY sig ORDER BY z) + (count(*) OVER (PARTITION BY sig, z) - 1) / 2.0 AS r FROM s)
SELECT x.sig AS a, y.sig AS b, round(corr(x.r, y.r), 6) AS rho FROM r x JOIN r y USING (grp, gene) WHERE x.sig < y.sig GROUP BY ALL""")
def spearman_concordance(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sig"), F.col("label").alias("grp"), F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    return ops.spearman(e).withColumn("rho", F.round("rho", 6))
