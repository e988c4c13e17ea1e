"""Identity queries: part names, supplier part sets, two kinds of identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexical
from ..operators import harmonize as ops
from .registry import query, table


@query("""WITH n AS (SELECT trim(regexp_replace(lower(trim(split_part(p_name, ' ', 1))), '[^a-z0-9]+', ' ', 'g')) AS name, p_partkey AS id, 0 AS tier FROM part
  UNION ALL SELECT trim(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', ' ', 'g')), p_partkey, 1 FROM part),
b AS (SELECT name, min(tier) AS tier FROM n GROUP BY name)
SELECT name, min(id) AS id, count(DISTINCT id) > 1 AS ambiguous FROM n JOIN b USING (name, tier) GROUP BY name""")
def name_index(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    preferred = p.select(lexical.normalise_name(F.split("p_name", " ")[0]).alias("name"), F.col("p_partkey").alias("id"), F.lit(0).alias("tier"))
    synonyms = p.select(lexical.normalise_name(F.col("p_type")).alias("name"), F.col("p_partkey").alias("id"), F.lit(1).alias("tier"))
    return ops.name_index(preferred.unionAll(synonyms))


_CROSSWALK = """WITH k AS (SELECT p_partkey AS key, p_brand AS name FROM part), tried AS (SELECT key, x.ord, x.id FROM k, LATERAL (VALUES (0, key * 2), (1, key + 7), (2, key // 2)) x(ord, id)),
f AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS code FROM lineitem WHERE l_returnflag = 'A'), s AS (SELECT p_brand AS name, min(p_size) AS code FROM part GROUP BY p_brand),
hit AS (SELECT key, arg_min(id, ord) AS id FROM (SELECT DISTINCT key, ord, tried.id FROM tried JOIN f USING (id)) GROUP BY key)
SELECT key, code, 'id' AS via FROM hit JOIN f USING (id) UNION ALL SELECT key, CAST(code AS BIGINT), 'name' FROM k JOIN s USING (name) WHERE key NOT IN (SELECT key FROM hit)"""


@query(_CROSSWALK)
def crosswalk_fallback(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = p.select(
        F.col("p_partkey").alias("key"), F.array(F.col("p_partkey") * 2, F.col("p_partkey") + 7, F.floor(F.col("p_partkey") / 2)).alias("ids"), F.col("p_brand").alias("name")
    )
    first = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("code")).distinct()
    second = p.groupBy(F.col("p_brand").alias("name")).agg(F.min("p_size").cast("bigint").alias("code"))
    return ops.fallback(k, first, second)


@query("""WITH m AS (SELECT o_custkey AS key, list_sort(list(DISTINCT l_suppkey % 4)) AS whole FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
r AS (SELECT c_custkey AS key, c_name AS name, whole FROM customer LEFT JOIN m ON key = c_custkey),
b AS (SELECT whole, arg_min(key, {'a': CASE WHEN length(trim(name)) = 0 THEN 99 ELSE length(name) END, 'k': key}) AS survivor FROM r WHERE len(whole) > 0 GROUP BY whole)
SELECT r.key, coalesce(b.survivor, r.key) AS survivor FROM r LEFT JOIN b ON r.whole = b.whole""")
def set_merge(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    m = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("key")).agg(F.collect_set(F.col("l_suppkey") % 4).alias("members"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return ops.merge_identical_sets(c.join(m, "key", "left"))


@query("""WITH rec AS (SELECT 'a:' || (o_custkey % 50) AS identifier, o_orderpriority AS section, o_orderstatus AS status FROM orders UNION ALL SELECT 'b:' || (c_custkey % 30), c_mktsegment, 'C' FROM customer),
c AS (SELECT DISTINCT s_suppkey AS key, identifier FROM supplier, LATERAL (VALUES ('a:' || (s_suppkey % 60)), ('b:' || (s_suppkey % 40)), ('b:' || (s_nationkey % 40))) x(identifier))
SELECT key, array_to_string(list_sort(list(DISTINCT section)), ' ') AS text, array_to_string(list_sort(list(DISTINCT status)), '|') AS statuses, count(*) AS n_records FROM c JOIN rec USING (identifier) GROUP BY key""")
def identifier_merge(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.concat(F.lit("a:"), F.col("o_custkey") % 50).alias("identifier"), F.col("o_orderpriority").alias("section"), F.col("o_orderstatus").alias("status"))
    b = table(spark, sf_dir, "customer").select(F.concat(F.lit("b:"), F.col("c_custkey") % 30).alias("identifier"), F.col("c_mktsegment").alias("section"), F.lit("C").alias("status"))
    ids = F.array(F.concat(F.lit("a:"), F.col("s_suppkey") % 60), F.concat(F.lit("b:"), F.col("s_suppkey") % 40), F.concat(F.lit("b:"), F.col("s_nationkey") % 40))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), ids.alias("ids"))
    return ops.merge_identifiers(s, a.unionAll(b))


_TERRITORY = """WITH m AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag = 'R'), a AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag <> 'R')"""


@query(f"""{_TERRITORY} SELECT s, count(*) FILTER (WHERE inm AND ina) AS n_both, count(*) FILTER (WHERE inm AND NOT ina) AS n_first, count(*) FILTER (WHERE ina AND NOT inm) AS n_second
FROM (SELECT coalesce(m.s, a.l_suppkey) AS s, m.s IS NOT NULL AS inm, a.l_suppkey IS NOT NULL AS ina FROM m FULL JOIN a ON m.s = a.l_suppkey AND m.p = a.l_partkey) GROUP BY s""")
def policy_territory(spark, sf_dir):
    """What two policies cover in common and alone, per supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", (F.col("l_returnflag") == "R").alias("first"))
    per = li.groupBy("l_suppkey", "l_partkey").agg(F.bool_or("first").alias("f"), F.bool_or(~F.col("first")).alias("g"))
    return per.groupBy(F.col("l_suppkey").alias("s")).agg(
        F.count_if(F.col("f") & F.col("g")).alias("n_both"), F.count_if(F.col("f") & ~F.col("g")).alias("n_first"), F.count_if(F.col("g") & ~F.col("f")).alias("n_second")
    )
