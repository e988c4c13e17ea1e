"""Ontology queries: world, regions, nations and segments; suppliers carry terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ontology as ops
from .registry import query, table
from ..functions.draws import draw_sql

PERMS, SEED, SIZE = 50, 11, 3
#: Line items that associate a supplier with a segment: about twice what any pair of them has.
LEAST = 9

_ONTO = f"""terms AS (SELECT 'W' AS term UNION SELECT 'R' || r_regionkey FROM region UNION SELECT 'N' || n_nationkey FROM nation UNION SELECT 'S' || c_nationkey || c_mktsegment FROM customer),
par AS (SELECT 'R' || r_regionkey AS term, 'W' AS parent FROM region UNION SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation UNION SELECT 'S' || c_nationkey || c_mktsegment, 'N' || c_nationkey FROM customer),
cl AS (SELECT term, term AS ancestor FROM terms UNION SELECT cl.term, par.parent FROM cl JOIN par ON par.term = cl.ancestor),
ann AS (SELECT l_suppkey AS entity, 'S' || c_nationkey || c_mktsegment AS term FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING count(*) >= {LEAST}),
ic AS (SELECT t.term, count(DISTINCT entity) AS n, -ln(greatest(count(DISTINCT entity), 1) / (SELECT count(DISTINCT entity) FROM ann)) AS ic FROM terms t LEFT JOIN cl ON cl.ancestor = t.term LEFT JOIN ann ON ann.term = cl.term GROUP BY t.term),
q AS (SELECT term FROM terms WHERE term IN ('S1BUILDING', 'S2MACHINERY', 'N3'))"""
_SIM = f"{_ONTO}, sim AS (SELECT a.term AS q, b.term, max(ic.ic) AS sim FROM cl a JOIN cl b USING (ancestor) JOIN ic ON ic.term = ancestor WHERE a.term IN (SELECT term FROM q) GROUP BY ALL)"
_SCORE = f"""{_ONTO}, sim AS (SELECT a.term AS q, b.term, max(ic.ic) AS sim FROM cl a JOIN cl b USING (ancestor) JOIN ic ON ic.term = ancestor GROUP BY ALL),
best AS (SELECT entity, q, max(sim) AS best FROM ann JOIN sim USING (term) GROUP BY ALL),
obs AS (SELECT entity, sum(best) / (SELECT count(*) FROM q) AS score FROM best WHERE q IN (SELECT term FROM q) GROUP BY entity),
pool AS (SELECT DISTINCT term FROM ann),
pn AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS place FROM pool),
dg AS (SELECT perm, list_transform(range(least({SIZE}, m)), lambda i: [{draw_sql(SEED, 'perm', 'i')} % (m - i)]) AS digits FROM range({PERMS}) t(perm), (SELECT count(*) AS m FROM pool)),
tk AS (SELECT perm, unnest(list_reduce(list_prepend([]::BIGINT[], digits), lambda taken, d: list_sort(list_append(taken, list_reduce(list_prepend(d[1], taken), lambda x, t: x + CASE WHEN x >= t THEN 1 ELSE 0 END))))) AS place FROM dg),
rq AS (SELECT perm, term FROM tk JOIN pn USING (place)),
nul AS (SELECT perm, entity, sum(best) / {SIZE}.0 AS score FROM rq JOIN best ON best.q = rq.term GROUP BY ALL),
pv AS (SELECT obs.entity, obs.score, (count(*) FILTER (WHERE nul.score >= obs.score - 1e-12) + 1) / ({PERMS} + 1) AS p FROM obs LEFT JOIN nul USING (entity) GROUP BY ALL)"""


def _segment(nation, segment):
    return F.concat(F.lit("S"), nation, segment)


def _ontology(spark, sf_dir):
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    seg = c.select(_segment("c_nationkey", "c_mktsegment").alias("term"), F.concat(F.lit("N"), "c_nationkey").alias("parent")).distinct()
    parents = (
        r.select(F.concat(F.lit("R"), "r_regionkey").alias("term"), F.lit("W").alias("parent"))
        .unionAll(n.select(F.concat(F.lit("N"), "n_nationkey"), F.concat(F.lit("R"), "n_regionkey")))
        .unionAll(seg)
    )
    terms = parents.select("term").unionAll(parents.select("parent")).distinct()
    return terms, ops.closure(parents, terms)


def _annotations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", _segment("c_nationkey", "c_mktsegment").alias("term"))
    named = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "term")  # line items are dealt out once, by order
    got = li.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
    return ops.cut(ops.associated(got.select(F.col("l_suppkey").alias("entity"), "term"), LEAST))  # read several times, and small


def _query(terms):
    return terms.filter(F.col("term").isin("S1BUILDING", "S2MACHINERY", "N3"))


@query(f"WITH RECURSIVE {_ONTO} SELECT term, ancestor FROM cl")
def ontology_closure(spark, sf_dir):
    return _ontology(spark, sf_dir)[1]


@query(f"WITH RECURSIVE {_ONTO} SELECT term, n, round(ic, 6) AS ic FROM ic")
def information_content(spark, sf_dir):
    terms, closed = _ontology(spark, sf_dir)
    return ops.information_content(_annotations(spark, sf_dir), closed, terms).select("term", "n", F.round("ic", 6).alias("ic"))


@query(f"WITH RECURSIVE {_SIM} SELECT q, term, round(sim, 6) AS sim FROM sim")
def resnik(spark, sf_dir):
    terms, closed = _ontology(spark, sf_dir)
    ic = ops.information_content(_annotations(spark, sf_dir), closed, terms)
    return ops.similarities(_query(terms), closed, ic).select("q", "term", F.round("sim", 6).alias("sim"))


def _evidence(spark, sf_dir):
    """Terms, annotations and the terms' information content, each computed once."""
    terms, closed = _ontology(spark, sf_dir)
    ann = _annotations(spark, sf_dir)
    return terms, closed, ann, ops.cut(ops.information_content(ann, closed, terms))


def _p_values(terms, closed, ann, ic):
    pool = ops.cut(ann.select("term").distinct())
    sims = ops.cut(ops.similarities(pool.union(_query(terms)), closed, ic))
    drawn = ops.cut(ops.random_queries(pool, SIZE, PERMS, SEED))
    return ops.permutation_p(ops.best_match(_query(terms), ann, sims, []), ops.best_match(drawn, ann, sims, ["perm"]), PERMS)


@query(f"WITH RECURSIVE {_SCORE} SELECT entity, round(score, 6) AS score, round(p, 6) AS p FROM pv")
def phenotype_p(spark, sf_dir):
    return _p_values(*_evidence(spark, sf_dir)).select("entity", F.round("score", 6).alias("score"), F.round("p", 6).alias("p"))


@query(f"WITH RECURSIVE {_SCORE} SELECT entity, round(p, 6) AS p, round(score, 6) AS score FROM pv WHERE p <= 0.5 ORDER BY round(p, 6), round(score, 6) DESC, entity LIMIT 20")
def top_entities(spark, sf_dir):
    r = _p_values(*_evidence(spark, sf_dir)).filter("p <= 0.5").select("entity", F.round("p", 6).alias("p"), F.round("score", 6).alias("score"))
    return r.orderBy("p", F.desc("score"), "entity").limit(20)


@query(f"""WITH RECURSIVE {_SIM}, lin AS (SELECT term AS t, ancestor AS q FROM cl UNION SELECT ancestor, term FROM cl)
SELECT lin.t AS term, round(max(sim / nullif(ic, 0)), 6) AS ratio FROM lin JOIN q ON q.term = lin.q JOIN sim ON sim.q = lin.q AND sim.term = lin.t JOIN ic ON ic.term = lin.q GROUP BY ALL""")
def term_ratio(spark, sf_dir):
    terms, closed = _ontology(spark, sf_dir)
    ic = ops.information_content(_annotations(spark, sf_dir), closed, terms)
    return ops.term_ratios(_query(terms), terms, closed, ic).select("term", F.round("ratio", 6).alias("ratio"))


@query(f"""WITH RECURSIVE {_SCORE}, hits AS (SELECT entity, score FROM pv WHERE p <= 0.5), a AS (SELECT l_partkey AS part, max(score) AS s, count(DISTINCT entity) AS n FROM hits JOIN lineitem ON l_suppkey = entity WHERE l_returnflag = 'A' GROUP BY 1),
b AS (SELECT l_partkey AS part, max(ic) AS s, count(DISTINCT term) AS n FROM ann JOIN ic USING (term) JOIN lineitem ON l_suppkey = entity WHERE l_returnflag = 'R' GROUP BY 1)
SELECT part, round(greatest(coalesce(a.s, 0), coalesce(b.s, 0)), 6) AS score, coalesce(a.n, 0) + coalesce(b.n, 0) AS support FROM a FULL JOIN b USING (part)""")
def indication_routes(spark, sf_dir):
    """Two routes from entities to parts, by hits and by terms; the better one scores."""
    terms, closed, ann, ic = _evidence(spark, sf_dir)
    hits = _p_values(terms, closed, ann, ic).filter("p <= 0.5").select("entity", "score")
    return ops.routes(hits, ann, ic, *_links(spark, sf_dir)).select(F.col("target").alias("part"), F.round(F.greatest("s", F.lit(0.0)), 6).alias("score"), "support")


def _links(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_partkey").alias("target"), "l_returnflag")
    return li.filter("l_returnflag = 'A'").drop("l_returnflag"), li.filter("l_returnflag = 'R'").drop("l_returnflag")
