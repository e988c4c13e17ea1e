"""Record queries: orders, parts, suppliers and documents stand for configurations, drugs and literature."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import burden, lexical
from ..functions.draws import draw_sql
from ..operators import graph
from ..operators import records as ops
from ..operators import signatures as sig
from ..operators import windows as win
from . import graphs, ontology, signatures, windows
from .evidence import TAIL, _names_sql, read_texts
from .registry import query, table


@query("""WITH ev AS (SELECT p_partkey AS key, p_brand AS value FROM part WHERE p_size <= 25)
SELECT l_orderkey AS id, string_agg(coalesce(value, '-'), '|' ORDER BY l_linenumber, l_partkey) AS evidence FROM lineitem LEFT JOIN ev ON key = l_partkey GROUP BY l_orderkey""")
def attach_evidence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    members = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    ev = table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("value"))
    out = ops.attach(li.groupBy(F.col("l_orderkey").alias("id")).agg(members.alias("members")), ev)
    return out.select("id", F.array_join("evidence", "|", "-").alias("evidence"))


_RESIDUE = "SELECT l_orderkey * 10 + l_linenumber AS {id}, l_partkey AS transcript, l_linenumber AS residue, l_suppkey % 4 AS change FROM lineitem WHERE l_returnflag = '{flag}'"


@query(f"""WITH a AS ({_RESIDUE.format(id='id', flag='A')}), b AS ({_RESIDUE.format(id='rec', flag='R')})
SELECT id, min(rec) AS rec FROM a JOIN b ON a.transcript = b.transcript AND a.residue = b.residue AND a.change <> b.change GROUP BY id""")
def same_residue(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")

    def of(flag, name):
        return li.filter(F.col("l_returnflag") == flag).selectExpr(f"l_orderkey * 10 + l_linenumber AS {name}", "l_partkey AS transcript", "l_linenumber AS residue", "l_suppkey % 4 AS change")

    return ops.same_residue(of("A", "id"), of("R", "rec"))


@query("""SELECT l_partkey AS gene, count(*) AS n_records, count(*) FILTER (WHERE l_returnflag = 'R') AS n_pathogenic, count(*) FILTER (WHERE l_discount > 0) AS n_annotated,
count(*) FILTER (WHERE coalesce(nullif(CAST(round(l_tax * 100) AS BIGINT), 3), 0) > 0) AS n_observed FROM lineitem GROUP BY l_partkey""")
def gene_context(spark, sf_dir):
    ac = F.nullif(F.round(F.col("l_tax") * 100).cast("bigint"), F.lit(3).cast("bigint"))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("gene")).agg(
        F.count("*").alias("n_records"), F.count_if(F.col("l_returnflag") == "R").alias("n_pathogenic"), F.count_if(F.col("l_discount") > 0).alias("n_annotated"), F.count_if(ops.observed(ac)).alias("n_observed")
    )


_CONTIGS = [*map(str, range(1, 23)), "X", "Y", "MT"]


@query(f"""WITH s AS (SELECT list_extract({_CONTIGS + ['other']}, CAST(l_suppkey % 26 AS INTEGER) + 1) AS contig, CASE WHEN l_linestatus = 'F' THEN 'XX' ELSE 'XY' END AS sex FROM lineitem)
SELECT contig, sex, CASE WHEN contig = 'Y' THEN 'hemizygous_mismapping' WHEN contig = 'X' AND sex <> 'XX' THEN 'not_diploid_under_inferred_sex_' || sex END AS reason, count(*) AS n FROM s WHERE contig <> 'other' GROUP BY ALL""")
def contig_exclusion(spark, sf_dir):
    names = F.array(*[F.lit(c) for c in [*_CONTIGS, "other"]])
    sex = F.when(F.col("l_linestatus") == "F", "XX").otherwise("XY")
    sites = table(spark, sf_dir, "lineitem").select(F.get(names, (F.col("l_suppkey") % 26).cast("int")).alias("contig"), sex.alias("sex"))
    kept, _ = ops.of_contigs(sites, _CONTIGS)
    return kept.groupBy("contig", "sex", ops.excluded_contigs(F.col("contig"), F.col("sex")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {graphs._DEG}, m AS (SELECT node FROM deg WHERE degree >= 2) SELECT src, dst, score FROM s WHERE src IN (SELECT node FROM m) AND dst IN (SELECT node FROM m)")
def induced_subgraph(spark, sf_dir):
    sym = graphs._sym(spark, sf_dir)
    return ops.induced(sym, graph.degree(sym).filter("degree >= 2"))


@query("""WITH m AS (SELECT unnest(['s' || l_suppkey, 's' || (l_suppkey % 10)]) AS drug, l_partkey AS gene FROM lineitem WHERE l_returnflag = 'R'),
p AS (SELECT p_partkey AS gene, p_brand AS protein FROM part WHERE p_size <= 25)
SELECT drug, coalesce(string_agg(DISTINCT protein, '|' ORDER BY protein), '') AS targets, count(DISTINCT CASE WHEN protein IS NULL THEN gene END) AS n_unmapped FROM m LEFT JOIN p USING (gene) GROUP BY drug""")
def drug_targets(spark, sf_dir):
    text = F.concat(F.lit("['s"), "l_suppkey", F.lit("', 's"), F.col("l_suppkey") % 10, F.lit("']"))
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    rows = li.select(lexical.as_list(text).alias("drugs"), lexical.as_list(F.col("l_partkey").cast("string")).alias("targets"))
    proteins = table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").cast("string").alias("gene"), F.col("p_brand").alias("protein"))
    out = ops.targets(rows, proteins)
    return out.select("drug", F.array_join("targets", "|").alias("targets"), F.size("unmapped").cast("bigint").alias("n_unmapped"))


_STAGE = "CASE p_size % 3 WHEN 0 THEN 'APPROVAL' WHEN 1 THEN 'PHASE_3' ELSE 'PHASE_1' END"


@query(f"""WITH d AS (SELECT DISTINCT l_partkey AS drug FROM lineitem), m AS (SELECT p_partkey AS drug, p_name AS name, {_STAGE} AS stage FROM part WHERE p_retailprice > 975),
i AS (SELECT DISTINCT l_partkey AS drug, l_suppkey AS indication FROM lineitem WHERE l_returnflag = 'A'), n AS (SELECT drug, count(*) AS n FROM i GROUP BY drug)
SELECT drug, coalesce(name, '') AS name, coalesce(stage, '') AS stage, coalesce(stage, '') = 'APPROVAL' AS approved, coalesce(n, 0) AS n_indications FROM d LEFT JOIN m USING (drug) LEFT JOIN n USING (drug)""")
def drug_records(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("drug"), F.col("l_suppkey").alias("indication"), F.when(F.col("l_returnflag") == "A", ops.APPROVED).otherwise("PHASE_2").alias("stage"))
    m = table(spark, sf_dir, "part").filter("p_retailprice > 975").selectExpr("p_partkey AS drug", "p_name AS name", f"{_STAGE} AS stage")
    return ops.drug_records(li.select("drug").distinct(), m, li)


@query("""WITH m AS (SELECT vec_id AS sig, CASE WHEN vec_id % 5 = 0 THEN 'control' ELSE 'compound' END AS kind, 'name' || label AS name, label FROM embeddings),
j AS (SELECT *, CASE WHEN kind <> 'compound' THEN 'no_compound' WHEN label > 6 THEN 'name_unresolved' WHEN label % 2 = 1 THEN 'not_approved' WHEN vec_id % 7 = 0 THEN 'not_in_matrix' END AS reason FROM m JOIN (SELECT vec_id FROM embeddings) ON vec_id = sig)
SELECT coalesce(reason, 'selected') AS reason, count(*) AS n_signatures, count(DISTINCT name) AS n_names FROM j GROUP BY ALL""")
def signature_selection(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    meta = e.select(F.col("vec_id").alias("sig"), F.when(F.col("vec_id") % 5 == 0, "control").otherwise("compound").alias("kind"), F.concat(F.lit("name"), "label").alias("name"))
    ids = e.select("label").distinct().filter("label <= 6")
    names = ids.select(F.concat(F.lit("name"), "label").alias("name"), F.col("label").alias("key"))
    molecules = ids.select(F.col("label").alias("key"), F.when(F.col("label") % 2 == 0, ops.APPROVED).alias("stage"))
    judged = ops.judged_signatures(meta, names, molecules, e.filter("vec_id % 7 <> 0").select(F.col("vec_id").alias("sig"), F.col("vec_id").alias("place")))
    return judged.groupBy(F.coalesce("reason", F.lit("selected")).alias("reason")).agg(F.count("*").alias("n_signatures"), F.countDistinct("name").alias("n_names"))


@query("""WITH a AS (SELECT DISTINCT l_partkey AS gene FROM lineitem WHERE l_returnflag = 'N'), b AS (SELECT DISTINCT l_partkey AS gene FROM lineitem WHERE l_returnflag <> 'N'), l AS (SELECT p_partkey AS gene FROM part WHERE p_size <= 30)
SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS i FROM a WHERE gene IN (SELECT gene FROM b) AND gene IN (SELECT gene FROM l)""")
def gene_axis(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")

    def release(some):
        return li.filter(some).select(F.col("l_partkey").alias("gene")).distinct().withColumn("place", F.col("gene"))

    landmarks = table(spark, sf_dir, "part").filter("p_size <= 30").select(F.col("p_partkey").alias("gene"))
    return ops.gene_axis(release("l_returnflag = 'N'"), release("l_returnflag <> 'N'"), landmarks)


_BUCKETS = f"""WITH w AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id), d AS (SELECT doc_id, lang, source, n_chars, coalesce(text, '') || {TAIL} AS text FROM documents),
f AS (SELECT doc_id, lang, CASE WHEN source = 'src3' THEN 'curated' ELSE 'retrieved' END AS origin, n_chars >= 20 AS citable, coalesce(toxic, 0) = 1 AS withdrawn, {_names_sql(lexical.SUPPORT)} AS support, {_names_sql(lexical.ADVERSE)} AS adverse,
  len(list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '(?i)licensed') AND regexp_matches(x, '(?i)under'))) > 0 AS cooccurs FROM d LEFT JOIN w USING (doc_id)),
c AS (SELECT *, CASE WHEN NOT citable THEN 'uncitable' WHEN withdrawn THEN 'withdrawn' WHEN len(adverse) > 0 THEN 'adverse_direction' WHEN origin = 'curated' THEN 'supporting_curated'
  WHEN NOT cooccurs THEN 'no_cooccurrence' WHEN len(support) = 0 THEN 'no_direction' ELSE 'supporting_retrieved' END AS bucket FROM f)"""


def _classified(spark, sf_dir):
    w = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", read_texts().alias("x")).join(w, "doc_id", "left")
    return ops.classified(d.select(
        "doc_id", "lang", F.when(F.col("source") == "src3", "curated").otherwise("retrieved").alias("origin"), (F.col("n_chars") >= 20).alias("citable"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("withdrawn"), "x.*",
    ))


@query(f"{_BUCKETS} SELECT doc_id, bucket, array_to_string(support, '|') AS support, array_to_string(adverse, '|') AS adverse FROM c")
def record_buckets(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "bucket", F.array_join("support", "|").alias("support"), F.array_join("adverse", "|").alias("adverse"))


@query(f"""{_BUCKETS} SELECT lang, count(*) AS n_examined, count(*) FILTER (WHERE origin = 'curated') AS n_curated, count(*) FILTER (WHERE origin = 'retrieved') AS n_retrieved,
{', '.join(f"count(*) FILTER (WHERE bucket = '{b}') AS n_{b}" for b in ('uncitable', 'withdrawn', 'adverse_direction', 'no_cooccurrence', 'no_direction'))},
count(*) FILTER (WHERE bucket LIKE 'supporting%') AS n_supporting, count(*) FILTER (WHERE bucket = 'supporting_curated') AS n_supporting_curated FROM c GROUP BY lang""")
def classification_counts(spark, sf_dir):
    return ops.bucket_counts(_classified(spark, sf_dir), "lang")


@query("""WITH o AS (SELECT o_custkey AS key, regexp_extract(o_orderpriority, '^\\d-(.*)$', 1) || CASE WHEN o_orderkey % 3 = 0 THEN ' - LATE' ELSE '' END AS text, o_orderkey AS ord FROM orders),
f AS (SELECT key, text, min(ord) AS ord FROM o WHERE text <> '' GROUP BY ALL)
SELECT key, list_reduce(list(text ORDER BY ord, text), lambda a, x: CASE WHEN contains(a, x) THEN a ELSE trim(a || ' ' || x) END) AS text FROM f GROUP BY key""")
def text_merge(spark, sf_dir):
    late = F.when(F.col("o_orderkey") % 3 == 0, " - LATE").otherwise("")
    o = table(spark, sf_dir, "orders")
    return ops.merged_texts(o.select(F.col("o_custkey").alias("key"), F.concat(F.regexp_extract("o_orderpriority", r"^\d-(.*)$", 1), late).alias("text"), F.col("o_orderkey").alias("ord")))


@query("""WITH n AS (SELECT DISTINCT lower(trim(x)) AS name FROM (SELECT unnest([p_brand, p_type]) AS x FROM part) WHERE trim(x) <> '')
SELECT count(*) AS n, sha256(string_agg(name, chr(10) ORDER BY name)) AS fingerprint FROM n""")
def positive_fingerprint(spark, sf_dir):
    return ops.fingerprint(table(spark, sf_dir, "part").select(F.explode(F.array("p_brand", "p_type")).alias("name")))


@query("""WITH f AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents), h AS (SELECT *, regexp_extract(t, '((?i)licensed|secret)', 1) AS hit FROM f),
p AS (SELECT *, strpos(t, hit) AS place FROM h), s AS (SELECT *, substr(t, 1, place - 1) AS before, substr(t, place + length(hit)) AS after FROM p),
e AS (SELECT *, trim(string_split(before, '.')[-1] || hit || string_split(after, '.')[1] || CASE WHEN contains(after, '.') THEN '.' ELSE '' END) AS sentence FROM s)
SELECT doc_id, substr(CASE WHEN hit <> '' AND sentence <> '' THEN sentence ELSE t END, 1, 400) AS snippet FROM e""")
def snippets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", lexical.snippet(F.col("text"), "(?i)licensed|secret", 400).alias("snippet"))


@query("""SELECT p_partkey AS key, '(TITLE_ABS:"' || p_brand || '" OR TITLE_ABS:"' || trim(p_type) || '") AND (TITLE_ABS:aneuploid* OR TITLE_ABS:"chromosomal instability")' AS query FROM part""")
def search_queries(spark, sf_dir):
    q = lexical.search_query("TITLE_ABS", F.array("p_brand", "p_type"), ["aneuploid*", "chromosomal instability"])
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), q.alias("query"))


@query(f"WITH RECURSIVE {ontology._ONTO}, u AS (SELECT term FROM cl WHERE ancestor = 'R1') SELECT term, count(DISTINCT entity) AS n_entities FROM u LEFT JOIN ann USING (term) GROUP BY term")
def ontology_subtree(spark, sf_dir):
    """Terms under a root, itself included, and the entities annotated with them."""
    from ..operators.ontology import subtree

    _, closed = ontology._ontology(spark, sf_dir)
    ann = ontology._annotations(spark, sf_dir)
    return subtree(closed, "R1").join(ann, "term", "left").groupBy("term").agg(F.countDistinct("entity").alias("n_entities"))


@query("SELECT p_partkey AS key, p_brand AS rationale FROM part WHERE p_size > 40")
def scope_narrowing(spark, sf_dir):
    """Rows narrowed to the survivors, and joined with them: none may lack its row."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("rationale"), "p_size")
    survivors = p.filter("p_size > 40").select("key")
    return ops.complete(ops.narrowed(p.select("key", "rationale"), survivors, "key", ["key"], 50), survivors, "key")


@query("""WITH s AS (SELECT p_partkey FROM part WHERE p_size > 45), n AS (SELECT l_partkey AS key, l_orderkey AS ord, l_linenumber AS line, 'some' AS survivors FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM s)),
f AS (SELECT l_partkey, l_orderkey, l_linenumber, 'none' FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem) WHERE n <= 50)
SELECT survivors, key, count(*) AS n, min(ord) AS first_ord FROM (SELECT * FROM n UNION ALL SELECT * FROM f) GROUP BY ALL""")
def scope_fallback(spark, sf_dir):
    """Rows of the survivors, each of its many; and where nothing survives the first rows in order."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"))
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_size")
    some, none = (ops.narrowed(rows, keys.filter(f"p_size > {least}"), "key", ["ord", "line", "key"], 50) for least in (45, 1000))
    both = some.withColumn("survivors", F.lit("some")).unionByName(none.withColumn("survivors", F.lit("none")))
    return both.groupBy("survivors", "key").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))


_STATUS = "CASE (p_partkey + p_size) % 5 WHEN 0 THEN 'practice_guideline' WHEN 1 THEN 'no_assertion_provided' WHEN 2 THEN 'flagged_' || p_size % 3 WHEN 3 THEN 'new_status' END"


@query(f"SELECT status, count(*) AS n FROM (SELECT {_STATUS} AS status FROM part) WHERE status LIKE 'flagged%' OR status = 'new_status' GROUP BY status")
def unmapped_statuses(spark, sf_dir):
    """Review states that the vocabulary does not know, counted rather than scored."""
    from ..functions.alleles import review_stars

    rows = table(spark, sf_dir, "part").select(F.expr(_STATUS).alias("status"))
    return ops.unmapped(rows, "status", review_stars(F.col("status")))


def _shift(m: str) -> str:
    steps = "list_prepend([0.0, 0.4999], list_transform(range(1, 31), lambda k: [k * 1.0, 0.0]))"
    fold = windows._fold("(b[1] + b[2]) / 2")
    half = f"list_reduce({steps}, lambda b, k: CASE WHEN {fold} < ({m}) THEN [(b[1] + b[2]) / 2, b[2]] ELSE [b[1], (b[1] + b[2]) / 2] END)"
    return f"CASE WHEN ({m}) <= s * sqrt(2 / pi()) THEN 0 WHEN ({m}) >= {windows._fold('0.4999')} THEN NULL ELSE ({half}[1] + {half}[2]) / 2 END"


@query(f"""WITH {windows.BASELINE}, sg AS (SELECT contig, any_value(baseline) AS baseline, any_value(sd) AS sd, 0.5 / sqrt(median(median_dp)) AS s FROM win, base WHERE median_dp IS NOT NULL GROUP BY contig),
x AS (SELECT contig, sd, s, {_shift('baseline + 0.5 * sd')} - {_shift('baseline')} AS d FROM sg)
SELECT contig, round(s, 6) AS sigma, round(CASE WHEN sd > 0 AND s > 0 THEN CASE WHEN greatest(0, d) <= 0 THEN 0 WHEN d <= 1.0 / 6 + 1e-12 THEN least(1, 4 * d / (1 - 2 * d)) END END, 4) AS smallest FROM x""")
def detection_limit(spark, sf_dir):
    """Per contig the least fraction that half a deviation over the baseline would show."""
    w = windows._windows(spark, sf_dir)
    base = win.robust_baseline(w, windows.MIN_HET)
    per = w.filter("median_dp IS NOT NULL").groupBy("contig").agg(F.median("median_dp").alias("dp")).withColumn("sigma", burden.sigma_at_depth(F.col("dp")))
    limit = burden.detection_limit(F.col("baseline"), F.col("sd"), F.col("sigma"), 0.5)
    return per.join(F.broadcast(base)).select("contig", F.round("sigma", 6).alias("sigma"), F.round(limit, 4).alias("smallest"))  # one row


WANTED, SEED, P_MAX = 6, 42, 0.6

_DEFLATED = f"""{signatures._MEANS}, ax AS (SELECT gene, avg(z) - avg(avg(z)) OVER () AS a FROM mn GROUP BY gene), ce AS (SELECT query, gene, z - avg(z) OVER (PARTITION BY query) AS c FROM mn),
df AS (SELECT query, gene, round(c - a * sum(c * a) OVER w / sum(a * a) OVER w, 9) AS z FROM ce JOIN ax USING (gene) WINDOW w AS (PARTITION BY query)),
th AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY z DESC, gene) AS h, row_number() OVER (PARTITION BY query ORDER BY z, gene DESC) AS l FROM df),
tl AS (SELECT query, gene, CASE WHEN h <= {signatures.SIZE} THEN 'up' ELSE 'down' END AS tail FROM th WHERE h <= {signatures.SIZE} OR l <= {signatures.SIZE})"""
_CHAIN = signatures._LADDER.replace(signatures._TAILS, _DEFLATED)


@query(f"""WITH {_CHAIN}, ctl AS (SELECT query FROM (SELECT DISTINCT query FROM mn) WHERE query <> 0 ORDER BY {draw_sql(SEED, 'query')}, query LIMIT {WANTED}),
pd AS (SELECT depth, (count(*) FILTER (WHERE n.score <= o.score) + 1) / (count(*) + 1) <= {P_MAX} AS passes FROM rung n JOIN rung o USING (depth) WHERE o.query = 0 AND n.query IN (SELECT query FROM ctl) AND depth IN (1, 5, 10, 25) GROUP BY depth),
dd AS (SELECT coalesce(max(depth) FILTER (WHERE passes), 0) AS depth FROM pd)
SELECT key, score, rank, percentile FROM (SELECT key, round(score, 9) AS score, row_number() OVER (ORDER BY round(score, 9), key) AS rank, 100 * row_number() OVER (ORDER BY round(score, 9), key) / count(*) OVER () AS percentile FROM mq WHERE query = 0), dd WHERE rank <= depth""")
def signature_nominees(spark, sf_dir):
    """Proxy, deflation, tails, connectivity, quantiles, null over other queries, nominees down to the deepest passing rung."""
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    means = sig.consensus(e, "label")
    flat = sig.deflate(means, means.groupBy("gene").agg(F.avg("z").alias("z"))).select("query", "gene", F.round("z", 9).alias("z"))
    scores = sig.normalise(sig.connectivity(sig.ranked(signatures._signatures(spark, sf_dir)), sig.query_tails(flat, signatures.SIZE)))
    best = sig.max_quantile(scores.select("query", F.col("grp").alias("key"), F.col("ncs").cast("double").alias("ncs")), "ncs", ["query", "key"])
    best = graph.cut(best.withColumn("score", F.round("score", 9)))
    controls = ops.control_queries(best, "0", WANTED, SEED)
    rungs = sig.ladder(best.join(controls.unionAll(controls.sparkSession.createDataFrame([(0,)], controls.schema)), "query", "left_semi"), signatures.DEPTHS)
    return ops.nominated(best.filter("query = 0").drop("query"), ops.deepest(sig.passing_depth(rungs, "0", P_MAX)))


@query(f"""WITH {_DEFLATED}, rh AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY z DESC, gene) AS h, row_number() OVER (PARTITION BY query ORDER BY z, gene DESC) AS l FROM mn),
raw AS (SELECT query, gene, CASE WHEN h <= {signatures.SIZE} THEN 'up' ELSE 'down' END AS tail FROM rh WHERE h <= {signatures.SIZE} OR l <= {signatures.SIZE})
SELECT query, tail, count(*) AS n_raw, count(tl.gene) AS n_shared FROM raw LEFT JOIN tl USING (query, gene, tail) GROUP BY query, tail""")
def tail_overlap(spark, sf_dir):
    """How much of each query's tails is left when the direction common to all queries is taken out."""
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    means = sig.consensus(e, "label")
    flat = sig.deflate(means, means.groupBy("gene").agg(F.avg("z").alias("z"))).select("query", "gene", F.round("z", 9).alias("z"))
    kept = sig.query_tails(flat, signatures.SIZE).withColumn("kept", F.lit(True))
    return sig.query_tails(means, signatures.SIZE).join(kept, ["query", "gene", "tail"], "left").groupBy("query", "tail").agg(F.count("*").alias("n_raw"), F.count("kept").alias("n_shared"))


RANDOM = 12
_DIGITS = ", ".join("[" + draw_sql(SEED, "query", str(i)) + f" % (n - {i})]" for i in range(2 * signatures.SIZE))
_HALVES = ", ".join("[" + draw_sql(SEED + 1, "query", str(i)) + f" % ({2 * signatures.SIZE} - {i})]" for i in range(signatures.SIZE))
_PICK = "list_reduce(list_prepend([]::BIGINT[], {digits}), lambda taken, d: list_sort(list_append(taken, list_reduce(list_prepend(d[1], taken), lambda x, t: x + CASE WHEN x >= t THEN 1 ELSE 0 END))))"
_RANDOM_TAILS = f"""{signatures._MEANS}, rg AS (SELECT q AS query, (SELECT count(DISTINCT gene) FROM mn) AS n FROM range(1, {RANDOM + 1}) t(q)),
rp AS (SELECT query, {_PICK.format(digits=f"[{_DIGITS}]")} AS genes, {_PICK.format(digits=f"[{_HALVES}]")} AS ups FROM rg),
rt AS (SELECT query, unnest(genes) AS gene, unnest(range(len(genes))) AS k, ups FROM rp),
th AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY z DESC, gene) AS h, row_number() OVER (PARTITION BY query ORDER BY z, gene DESC) AS l FROM mn WHERE query = 0),
tl AS (SELECT query, gene, CASE WHEN list_contains(ups, k) THEN 'up' ELSE 'down' END AS tail FROM rt UNION ALL SELECT 0, gene, CASE WHEN h <= {signatures.SIZE} THEN 'up' ELSE 'down' END FROM th WHERE h <= {signatures.SIZE} OR l <= {signatures.SIZE})"""


@query(f"""WITH {signatures._MAXQ.replace(signatures._TAILS, _RANDOM_TAILS)}, b AS (SELECT query, round(min(score), 9) AS best FROM mq GROUP BY query), z AS (SELECT query, count(*) FILTER (WHERE wtcs = 0) / count(*) AS zero FROM wt GROUP BY query)
SELECT query, round(best, 6) AS best, round(zero, 6) AS zero, CASE WHEN query = 0 THEN round(((SELECT count(*) FROM b WHERE query <> 0 AND best <= (SELECT best FROM b WHERE query = 0)) + 1) / ({RANDOM} + 1), 6) END AS p FROM b JOIN z USING (query)""")
def random_query_null(spark, sf_dir):
    """The best score of one query against those of random genes, and the share of signatures that score nothing."""
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    observed = sig.query_tails(sig.consensus(e, "label").filter("query = 0"), signatures.SIZE).select(F.col("query").cast("long").alias("query"), "gene", "tail")
    n = e.select(F.max(F.size("z")).alias("n")).first()["n"]
    tails = observed.unionByName(sig.random_tails(spark, n, signatures.SIZE, RANDOM, SEED))
    scores = graph.cut(sig.normalise(sig.connectivity(sig.ranked(signatures._signatures(spark, sf_dir)), tails)).withColumn("ncs", F.col("ncs").cast("double")))
    best = sig.max_quantile(scores.withColumnRenamed("grp", "key"), "ncs", ["query", "key"]).groupBy("query").agg(F.round(F.min("score"), 9).alias("best"))
    zero = scores.groupBy("query").agg((F.count_if(F.col("wtcs") == 0) / F.count("*")).alias("zero"))
    best = graph.cut(best)
    own = best.filter("query = 0").select(F.col("best").alias("own"))
    p = best.filter("query <> 0").join(F.broadcast(own), F.col("best") <= F.col("own"), "left_semi").agg(F.round((F.count("*") + 1) / (RANDOM + 1), 6).alias("p"))  # a row each
    return best.join(zero, "query").join(F.broadcast(p)).select("query", F.round("best", 6).alias("best"), F.round("zero", 6).alias("zero"), F.when(F.col("query") == 0, F.col("p")).alias("p"))


HEAD = 3


@query(f"""WITH {signatures._MAXQ}, h AS (SELECT query, key FROM (SELECT query, key, row_number() OVER (PARTITION BY query ORDER BY round(score, 9), key) AS n FROM mq) WHERE n <= {HEAD})
SELECT a.query, count(*) AS n_head, count(b.key) AS n_shared FROM h a LEFT JOIN (SELECT key FROM h WHERE query = 0) b USING (key) WHERE a.query <> 0 GROUP BY a.query""")
def head_overlap(spark, sf_dir):
    """How many of the first nominees of each other query are those of the observed one too."""
    scores = graph.cut(signatures._quantiles(spark, sf_dir).withColumn("score", F.round("score", 9)))
    head = ops.capped(scores, ["query"], ["score", "key"], HEAD).select("query", "key")
    own = head.filter("query = 0").select("key", F.lit(True).alias("here"))
    return head.filter("query <> 0").join(own, "key", "left").groupBy("query").agg(F.count("*").alias("n_head"), F.count("here").alias("n_shared"))
