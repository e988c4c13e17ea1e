"""Graph queries: customers and parts joined by urgent bulk orders; suppliers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.draws import draw, draw_sql
from ..operators import graph as ops
from ..operators import nulls
from .registry import query, table

BIN, PERMS, SEED, ROUNDS, RESTART, HOPS = 50, 50, 42, 24, 0.7, 64

_PAIRS = """pairs AS (SELECT 'c' || o_custkey AS a, 'p' || l_partkey AS b, l_quantity * 20 AS score FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderpriority = '1-URGENT')"""
_EDGES = f"{_PAIRS}, e AS (SELECT least(a, b) AS a, greatest(a, b) AS b, max(score) AS score FROM pairs WHERE a <> b AND score >= 900 GROUP BY ALL)"
_SYM = f"{_EDGES}, s AS (SELECT a AS src, b AS dst, score FROM e UNION ALL SELECT b, a, score FROM e)"
_DEG = f"{_SYM}, deg AS (SELECT src AS node, count(*) AS degree FROM s GROUP BY src)"
_BINS = f"{_DEG}, bins AS (SELECT node, degree, CAST(least((rn - 1) // {BIN}, greatest(n // {BIN} - 1, 0)) AS BIGINT) AS bin FROM (SELECT *, row_number() OVER (ORDER BY degree, node) AS rn, count(*) OVER () AS n FROM deg))"
_DIST = f"{_BINS}, src AS (SELECT node FROM deg JOIN (SELECT 'p' || p_partkey AS node FROM part WHERE p_type LIKE 'PROMO%') USING (node)), walk AS (SELECT node, CAST(0 AS BIGINT) AS d FROM src UNION SELECT s.dst, d + 1 FROM walk JOIN s ON s.src = walk.node WHERE d < {HOPS}), dist AS (SELECT node, min(d) AS distance FROM walk GROUP BY node)"


def _pairs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("c"), "o_custkey").alias("a"), F.concat(F.lit("p"), "l_partkey").alias("b"), (F.col("l_quantity") * 20).alias("score")
    )


def _sym(spark, sf_dir):
    return ops.cut(ops.both_ways(ops.build_edges(_pairs(spark, sf_dir), 900)))


def _distances(spark, sf_dir, sym):
    promo = table(spark, sf_dir, "part").filter(F.col("p_type").startswith("PROMO")).select(F.concat(F.lit("p"), "p_partkey").alias("node"))
    return ops.bfs_distances(sym, promo.join(sym.select(F.col("src").alias("node")).distinct(), "node", "left_semi"))


@query(f"WITH {_EDGES} SELECT * FROM e")
def graph_edges(spark, sf_dir):
    return ops.build_edges(_pairs(spark, sf_dir), 900)


@query(f"WITH {_DEG} SELECT * FROM deg")
def graph_degree(spark, sf_dir):
    return ops.degree(ops.both_ways(ops.build_edges(_pairs(spark, sf_dir), 900)))


@query(f"WITH {_BINS} SELECT node, degree, bin FROM bins")
def degree_bins(spark, sf_dir):
    return ops.degree_bins(graph_degree(spark, sf_dir), BIN)


@query(f"WITH RECURSIVE {_DIST} SELECT * FROM dist")
def bfs_distance(spark, sf_dir):
    return _distances(spark, sf_dir, _sym(spark, sf_dir))


_REACH = f"WITH RECURSIVE {_SYM}, r AS (SELECT src AS node, src AS reach FROM s UNION SELECT r.node, s.dst FROM r JOIN s ON s.src = r.reach)"


@query(f"{_REACH} SELECT node, min(reach) AS component FROM r GROUP BY node")
def component(spark, sf_dir):
    return ops.components(_sym(spark, sf_dir))


@query(f"{_REACH}, c AS (SELECT node, min(reach) AS component FROM r GROUP BY node), b AS (SELECT component FROM c GROUP BY component ORDER BY count(*) DESC, component LIMIT 1) SELECT node FROM c JOIN b USING (component)")
def largest_component(spark, sf_dir):
    return ops.largest_component(_sym(spark, sf_dir))


_TARGETS = f"{_DIST}, tg AS (SELECT src AS key, dst AS node FROM s WHERE src LIKE 'c%'), used AS (SELECT key, node, distance FROM tg JOIN dist USING (node)), obs AS (SELECT key, avg(distance) AS d, count(*) AS n FROM used GROUP BY key)"
_NULL = f"""{_TARGETS}, pool AS (SELECT node, bin, distance, row_number() OVER (PARTITION BY bin ORDER BY node) - 1 AS i, count(*) OVER (PARTITION BY bin) AS m FROM bins JOIN dist USING (node)),
drawn AS (SELECT key, perm, b.bin, {draw_sql(SEED, 'key', 'node', 'perm')} % m AS i FROM used JOIN bins b USING (node) JOIN (SELECT DISTINCT bin, m FROM pool) z ON z.bin = b.bin, range({PERMS}) t(perm)),
nul AS (SELECT key, perm, avg(distance) AS d FROM drawn JOIN pool ON pool.bin = drawn.bin AND pool.i = drawn.i GROUP BY ALL),
st AS (SELECT key, avg(d) AS mean, stddev_samp(d) AS sd FROM nul GROUP BY key),
zs AS (SELECT obs.key, obs.d, obs.n, CASE WHEN sd > 1e-12 THEN (obs.d - mean) / sd END AS z FROM obs LEFT JOIN st USING (key))"""


def _scored(spark, sf_dir):
    sym = _sym(spark, sf_dir)
    dist = _distances(spark, sf_dir, sym)
    bins = ops.degree_bins(ops.degree(sym), BIN)
    targets = sym.filter("src LIKE 'c%'").select(F.col("src").alias("key"), F.col("dst").alias("node"))
    observed = nulls.mean_distance(targets, dist)
    null = nulls.matched_null(targets, bins, dist, PERMS, SEED)
    return nulls.z_scores(observed, null).withColumn("z", F.when(F.col("sd") > 1e-12, F.col("z")))


@query(f"WITH RECURSIVE {_NULL} SELECT key, round(d, 6) AS d, n, round(z, 6) AS z FROM zs")
def proximity_z(spark, sf_dir):
    return _scored(spark, sf_dir).select("key", F.round("d", 6).alias("d"), "n", F.round("z", 6).alias("z"))


@query(f"WITH RECURSIVE {_NULL} SELECT key, row_number() OVER (ORDER BY round(z, 6) NULLS LAST, round(d, 6) NULLS LAST, key) AS rank FROM zs ORDER BY 2 LIMIT 50")
def proximity_rank(spark, sf_dir):
    order = [F.round("z", 6).asc_nulls_last(), F.round("d", 6).asc_nulls_last(), F.col("key")]
    top = _scored(spark, sf_dir).orderBy(*order).limit(50)
    from pyspark.sql import Window

    return top.select("key", F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"))


_SP = """sp AS (SELECT 's' || l_suppkey AS a, 'p' || l_partkey AS b, max(l_quantity) AS score FROM lineitem GROUP BY ALL HAVING max(l_quantity) >= 40),
g AS (SELECT a AS src, b AS dst, score FROM sp UNION ALL SELECT b, a, score FROM sp), strong AS (SELECT src, sum(score) AS total FROM g GROUP BY src),
mv AS (SELECT g.src, dst, score / total AS share FROM g JOIN strong USING (src)),
seed AS (SELECT DISTINCT node FROM (SELECT src AS node FROM g WHERE src = 's1' UNION ALL SELECT dst FROM g WHERE src = 's1' AND score >= 48)),
home AS (SELECT src AS node, CASE WHEN src IN (SELECT node FROM seed) THEN 1.0 / (SELECT count(*) FROM seed) ELSE 0 END AS home FROM strong), w0 AS (SELECT node, home AS score FROM home)"""


def _walk_sql(rounds: int) -> str:
    steps = [
        f"w{k} AS (SELECT home.node, {1 - RESTART!r} * coalesce(inflow, 0) + {RESTART} * home AS score FROM home LEFT JOIN (SELECT dst AS node, sum(score * share) AS inflow FROM w{k - 1} JOIN mv ON mv.src = w{k - 1}.node GROUP BY dst) USING (node))"
        for k in range(1, rounds + 1)
    ]
    return ", ".join([_SP, *steps])


def _supplier_parts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pairs = li.select(F.concat(F.lit("s"), "l_suppkey").alias("a"), F.concat(F.lit("p"), "l_partkey").alias("b"), F.col("l_quantity").alias("score"))
    return ops.cut(ops.both_ways(ops.build_edges(pairs, 40)))


@query(f"WITH {_SP} SELECT node FROM seed")
def seed_module(spark, sf_dir):
    return ops.seeds(_supplier_parts(spark, sf_dir), "s1", 48)


@query(f"WITH {_walk_sql(ROUNDS)} SELECT node, round(score, 6) AS score FROM w{ROUNDS}")
def random_walk(spark, sf_dir):
    g = _supplier_parts(spark, sf_dir)
    return ops.random_walk(g, ops.seeds(g, "s1", 48), RESTART, ROUNDS).select("node", F.round("score", 6).alias("score"))


@query(f"WITH {_walk_sql(ROUNDS)} SELECT node, is_seed, row_number() OVER (ORDER BY is_seed DESC, score DESC, node) AS rank FROM (SELECT node, node IN (SELECT node FROM seed) AS is_seed, round(score, 7) AS score FROM w{ROUNDS}) ORDER BY 3 LIMIT 100")
def module_topk(spark, sf_dir):
    g = _supplier_parts(spark, sf_dir)
    seeds = ops.cut(ops.seeds(g, "s1", 48))
    walk = ops.random_walk(g, seeds, RESTART, ROUNDS).withColumn("score", F.round("score", 7))
    return ops.top_module(walk, seeds, 100).select("node", "is_seed", F.col("rank").cast("bigint").alias("rank"))


@query("""WITH m AS (SELECT 'p' || p_partkey AS node, p_brand AS grp FROM part UNION SELECT 'p' || p_partkey, p_type FROM part),
small AS (SELECT grp FROM m GROUP BY grp HAVING count(*) <= 100), own AS (SELECT grp FROM m JOIN small USING (grp) WHERE node = 'p1'),
sh AS (SELECT node, list_sort(list(DISTINCT grp)) AS shared FROM m JOIN own USING (grp) GROUP BY node)
SELECT n.node, CASE WHEN shared IS NULL THEN 'downstream' ELSE 'upstream' END AS side, coalesce(array_to_string(shared, '|'), '') AS shared FROM (SELECT DISTINCT node FROM m) n LEFT JOIN sh USING (node)""")
def pathway_split(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("node"), "p_brand", "p_type")
    m = p.select("node", F.col("p_brand").alias("grp")).union(p.select("node", "p_type")).distinct()
    out = ops.split_by_groups(p, m, "p1", 100)
    return out.withColumn("shared", F.array_join("shared", "|"))


@query("""WITH RECURSIVE up AS (SELECT p_partkey AS id, p_partkey AS place, 0 AS hops FROM part
  UNION ALL SELECT id, place // 2, hops + 1 FROM up WHERE place // 2 >= 1 AND hops < 10)
SELECT id, arg_min(place, -hops) AS root, CAST(max(hops) AS BIGINT) AS hops FROM up GROUP BY id""")
def resolve_parent(spark, sf_dir):
    parent = F.floor(F.col("p_partkey") / 2)
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(parent >= 1, parent).alias("parent"))
    return ops.resolve_parents(p)


@query(f"SELECT {draw_sql(7, 'l_orderkey', 'l_linenumber')} % 97 AS v, count(*) AS n, min(l_orderkey) AS first_key FROM lineitem GROUP BY 1")
def hash_draws(spark, sf_dir):
    """How evenly stateless draws fall over every line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy((draw(7, F.col("l_orderkey"), F.col("l_linenumber")) % 97).alias("v")).agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first_key"))
