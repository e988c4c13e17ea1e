"""Allele, annotation and interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import alleles as fn
from ..operators import intervals as ops
from .registry import query, table

REGIONS = [("GENE1", 1, 1000, 2000), ("GENE2", 2, 5000, 6000), ("GENE3", 1, 1500, 9000), ("GENE4", 3, 20000, 40000)]
PAD = 100
_VALUES = "regions(gene, contig, \"start\", \"end\") AS (VALUES " + ", ".join(f"('{g}', {c}, {s}, {e})" for g, c, s, e in REGIONS) + ")"
_POINTS = "points AS (SELECT o_orderkey AS id, o_custkey % 5 AS contig, o_orderkey AS pos FROM orders)"
_JOINED = f"WITH {_VALUES}, {_POINTS}, j AS (SELECT id, p.contig, pos, gene FROM points p JOIN regions r ON p.contig = r.contig AND pos BETWEEN \"start\" - {PAD} AND \"end\" + {PAD})"


def _points(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 5).alias("contig"), F.col("o_orderkey").alias("pos"))


def _regions(spark):
    return spark.createDataFrame(REGIONS, "gene string, contig long, start long, end long")


@query(f"{_JOINED} SELECT id, contig, gene FROM j")
def interval_join(spark, sf_dir):
    return ops.in_regions(_points(spark, sf_dir), _regions(spark), PAD).select("id", "contig", "gene")


@query(f"{_JOINED} SELECT id, min(gene) AS gene FROM j GROUP BY id")
def first_region(spark, sf_dir):
    return ops.first_region(_points(spark, sf_dir), _regions(spark), PAD).select("id", "gene")


@query(f"{_JOINED} SELECT id, pos FROM points p WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.id = p.id)")
def outside_regions(spark, sf_dir):
    p = _points(spark, sf_dir)
    return p.join(ops.in_regions(p, _regions(spark), PAD).select("id"), "id", "left_anti").select("id", "pos")


_SPREAD = """genes AS (SELECT 'G' || p_partkey AS gene, p_partkey % 5 AS contig, (p_partkey * 7919) % 60000 AS start, CASE WHEN p_size <= 2 THEN 1000000000 WHEN p_size % 5 = 0 THEN 9000 ELSE p_size END AS width FROM part)"""


@query(f"""WITH {_SPREAD}, {_POINTS} SELECT gene, count(*) AS n_points, min(id) AS first_id FROM genes g JOIN points p ON p.contig = g.contig AND pos BETWEEN start - {PAD} AND start + width + {PAD} GROUP BY gene""")
def mixed_regions(spark, sf_dir):
    """Points in regions of a few bases and of whole contigs."""
    width = F.when(F.col("p_size") <= 2, 1_000_000_000).when(F.col("p_size") % 5 == 0, 9000).otherwise(F.col("p_size"))
    start = (F.col("p_partkey") * 7919) % 60000
    genes = table(spark, sf_dir, "part").select(F.concat(F.lit("G"), "p_partkey").alias("gene"), (F.col("p_partkey") % 5).alias("contig"), start.alias("start"), (start + width).alias("end"))
    return ops.totals_in_regions(_points(spark, sf_dir), genes, PAD)


_NEAR = """WITH p AS (SELECT o_orderkey AS id, o_custkey % 7 AS contig, o_orderkey AS pos FROM orders WHERE o_orderpriority = '1-URGENT'),
s AS (SELECT l_suppkey % 7 AS contig, l_orderkey AS pos, CAST(l_quantity AS DOUBLE) AS an FROM lineitem WHERE l_returnflag = 'A')"""


@query(f"""{_NEAR} SELECT id, count(*) AS n_near, median(an) AS an_median, max(an) AS an_max, round(median(an) / max(an), 4) AS ratio
FROM p JOIN s ON p.contig = s.contig AND abs(p.pos - s.pos) <= 50 GROUP BY id""")
def nearby_band(spark, sf_dir):
    p = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 7).alias("contig"), F.col("o_orderkey").alias("pos"))
    s = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'").select((F.col("l_suppkey") % 7).alias("contig"), F.col("l_orderkey").alias("pos"), F.col("l_quantity").cast("double").alias("an"))
    got = ops.near(p, s, 50).groupBy("id").agg(F.count("*").alias("n_near"), F.median("an").alias("an_median"), F.max("an").alias("an_max"))
    return got.withColumn("ratio", F.round(F.try_divide("an_median", "an_max"), 4))


#: Bases that references and alternatives are cut from, so that they share ends of every length.
_REF, _ALT = "ACGGTACGTTAGACGT", "ACGGTTACGTAGACTT"
_RAW = f"""raw AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey, l_partkey, l_returnflag, l_orderkey AS in_pos, substr('{_REF}', CAST(1 + l_partkey % 5 AS BIGINT), CAST(1 + l_linenumber AS BIGINT)) AS in_ref,
  lower(substr('{_ALT}', CAST(1 + l_partkey % 5 AS BIGINT), CAST(1 + l_suppkey % 6 AS BIGINT))) AS in_alt FROM lineitem)"""
_MINIMAL = f"""{_RAW}, u AS (SELECT *, upper(in_ref) AS r, upper(in_alt) AS a FROM raw),
t AS (SELECT *, list_max(list_filter(range(0, least(length(r), length(a))), lambda k: k = 0 OR right(r, k) = right(a, k))) AS k FROM u),
c AS (SELECT * EXCLUDE (r, a, k), left(r, length(r) - k) AS r, left(a, length(a) - k) AS a FROM t),
p AS (SELECT *, list_max(list_filter(range(0, least(length(r), length(a))), lambda k: k = 0 OR left(r, k) = left(a, k))) AS k FROM c),
m AS (SELECT *, CAST(in_pos + k AS BIGINT) AS pos, substr(r, CAST(k AS BIGINT) + 1) AS ref, substr(a, CAST(k AS BIGINT) + 1) AS alt FROM p)"""


def _raw(spark, sf_dir):
    """Alleles as callers write them: of any length, with shared ends, in either case."""
    start = (1 + F.col("l_partkey") % 5).cast("int")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_suppkey", "l_partkey", "l_returnflag", F.col("l_orderkey").alias("in_pos"),
        F.substr(F.lit(_REF), start, (1 + F.col("l_linenumber")).cast("int")).alias("in_ref"), F.lower(F.substr(F.lit(_ALT), start, (1 + F.col("l_suppkey") % 6).cast("int"))).alias("in_alt"),
    )


@query(f"WITH {_MINIMAL} SELECT id, in_ref, in_alt, pos, ref, alt FROM m")
def minimal_alleles(spark, sf_dir):
    return fn.with_minimal(_raw(spark, sf_dir), "in_pos", "in_ref", "in_alt").select("id", "in_ref", "in_alt", "m.*")


_KEYED = f"""{_MINIMAL}, a AS (SELECT id, 'chr' || (l_suppkey % 3) AS contig, pos, ref, alt FROM m WHERE l_returnflag = 'R'),
b AS (SELECT l_partkey AS rec, CAST(l_suppkey % 3 AS VARCHAR) AS contig, pos, ref, alt FROM m WHERE l_returnflag <> 'N')"""


def _keyed(spark, sf_dir):
    """Calls and archive records, both brought to their minimal form: that is what they are joined by."""
    rows = fn.with_minimal(_raw(spark, sf_dir), "in_pos", "in_ref", "in_alt")
    bare = (F.col("l_suppkey") % 3).cast("string")
    a = rows.filter("l_returnflag = 'R'").select("id", fn.bare_contig(F.concat(F.lit("chr"), bare)).alias("contig"), "m.*")
    b = rows.filter("l_returnflag <> 'N'").select(F.col("l_partkey").alias("rec"), bare.alias("contig"), "m.*")
    return a, b


@query(f"WITH {_KEYED} SELECT a.id, a.contig AS contig, count(*) AS n_exact, min(rec) AS first_rec FROM (SELECT pos, ref, alt, id, substr(contig, 4) AS contig FROM a) a JOIN b USING (contig, pos, ref, alt) GROUP BY ALL")
def allele_match(spark, sf_dir):
    a, b = _keyed(spark, sf_dir)
    return a.join(b, ["contig", "pos", "ref", "alt"]).groupBy("id", "contig").agg(F.count("*").alias("n_exact"), F.min("rec").alias("first_rec"))


@query(f"WITH {_KEYED} SELECT a.id, count(*) AS n_other FROM (SELECT pos, ref, alt, id, substr(contig, 4) AS contig FROM a) a JOIN b ON a.contig = b.contig AND a.pos = b.pos AND (a.ref <> b.ref OR a.alt <> b.alt) GROUP BY ALL")
def same_position_other_allele(spark, sf_dir):
    a, b = _keyed(spark, sf_dir)
    b = b.select("contig", "pos", F.col("ref").alias("bref"), F.col("alt").alias("balt"))
    return a.join(b, ["contig", "pos"]).filter("ref <> bref OR alt <> balt").groupBy("id").agg(F.count("*").alias("n_other"))


SIGNIFICANCE = ["Pathogenic", "Pathogenic/Likely_pathogenic", "Pathogenic|risk_factor", "Pathogenic_low_penetrance", "Likely_pathogenic", "Benign", "Benign/Likely_benign", "Likely_benign", "Uncertain_significance", "Conflicting_classifications_of_pathogenicity", "Conflicting_interpretations_of_pathogenicity", "drug_response", ""]


_STATED = f"list_extract({SIGNIFICANCE}, CAST(1 + (l_partkey + l_linenumber) % {len(SIGNIFICANCE)} AS INTEGER)) || CASE WHEN l_suppkey % 4 = 0 THEN '|risk_factor' ELSE '' END"


@query(f"""WITH v AS (SELECT {_STATED} AS s FROM lineitem),
p AS (SELECT s, list_transform(string_split(string_split(s, '|')[1], '/'), lambda x: trim(replace(x, '_low_penetrance', ''), '_')) AS parts FROM v)
SELECT s AS clnsig, CASE WHEN list_has_any(parts, ['Conflicting_classifications_of_pathogenicity', 'Conflicting_interpretations_of_pathogenicity']) THEN 'conflicting'
 WHEN list_contains(parts, 'Pathogenic') THEN 'pathogenic' WHEN list_contains(parts, 'Likely_pathogenic') THEN 'likely_pathogenic'
 WHEN list_contains(parts, 'Benign') THEN 'benign' WHEN list_contains(parts, 'Likely_benign') THEN 'likely_benign'
 WHEN list_has_any(parts, ['Uncertain_significance', 'Uncertain_risk_allele']) THEN 'uncertain' ELSE 'other' END AS class, count(*) AS n FROM p GROUP BY ALL""")
def significance_class(spark, sf_dir):
    stated = F.get(F.array(*[F.lit(s) for s in SIGNIFICANCE]), ((F.col("l_partkey") + F.col("l_linenumber")) % len(SIGNIFICANCE)).cast("int"))
    v = table(spark, sf_dir, "lineitem").select(F.concat(stated, F.when(F.col("l_suppkey") % 4 == 0, "|risk_factor").otherwise("")).alias("clnsig"))
    return v.groupBy("clnsig", fn.significance_class(F.col("clnsig")).alias("class")).agg(F.count("*").alias("n"))


@query(f"""WITH m(status, stars) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in fn.REVIEW_STARS.items())}),
s AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'practice_guideline' WHEN 1 THEN 'criteria_provided,_single_submitter' WHEN 2 THEN 'no_assertion_provided' ELSE 'something_new' END AS status FROM part)
SELECT s.status, CAST(stars AS BIGINT) AS stars, count(*) AS n FROM s LEFT JOIN m USING (status) GROUP BY ALL""")
def review_stars(spark, sf_dir):
    size = F.col("p_size") % 4
    status = F.when(size == 0, "practice_guideline").when(size == 1, "criteria_provided,_single_submitter").when(size == 2, "no_assertion_provided").otherwise("something_new")
    s = table(spark, sf_dir, "part").select(status.alias("status"))
    return s.groupBy("status").agg(F.count("*").alias("n")).withColumn("stars", fn.review_stars(F.col("status")).cast("bigint"))


#: What an annotation field may say, by the remainder of a key.
EFFECTS = ["stop_gained", "missense_variant", "splice_donor_variant&intron_variant", "synonymous_variant", "frameshift_variant", "intron_variant", "exon_loss_variant"]
BIOTYPES = ["protein_coding", "protein_coding", "retained_intron"]


def _info(pick, text, glue) -> str:
    """An INFO text of two annotations and a short one, in either engine's SQL."""

    def one(k):
        effect, impact = pick(EFFECTS, f"(l_partkey + {k}) % 7"), pick(fn.IMPACTS, f"(l_linenumber + {k}) % 4")
        rank = glue([text(f"1 + (l_suppkey + {k}) % 3"), "'/3'"])
        protein = f"CASE WHEN l_orderkey % 5 = {k} THEN '' ELSE " + glue(["'p.Arg'", text("1 + l_orderkey % 900"), "'Ter'"]) + " END"
        gene, transcript = glue(["'G'", text(f"l_partkey % 9 + {k} * (l_suppkey % 2)")]), glue(["'TX'", text(f"(l_suppkey + 3 * {k}) % 10")])
        return glue(["'T|'", effect, "'|'", impact, "'|'", gene, "'|id|transcript|'", transcript, "'|'", pick(BIOTYPES, f"(l_orderkey + {k}) % 3"), "'|'", rank, "'|c.1A>T|'", protein, "'|'"])

    return glue(["'AC=2;DB;ANN='", one(0), "','", one(1), "',G|short|HIGH;AF=0.5;NOTE=a=b'"])


_INFO_SQL = _info(lambda xs, k: f"list_extract({xs}, CAST(1 + {k} AS INTEGER))", lambda x: f"CAST({x} AS VARCHAR)", " || ".join)
_INFO = _info(lambda xs, k: f"array({', '.join(map(repr, xs))})[CAST({k} AS INT)]", lambda x: f"CAST({x} AS STRING)", lambda xs: f"concat({', '.join(xs)})")


@query(f"""WITH v AS (SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, {_INFO_SQL} AS info FROM lineitem),
i AS (SELECT id, list_filter(string_split(info, ';'), lambda x: starts_with(x, 'ANN='))[-1][5:] AS ann FROM v),
e AS (SELECT id, string_split(x, '|') AS p FROM (SELECT id, unnest(string_split(ann, ',')) AS x FROM i)),
f AS (SELECT id, p[4] AS gene, p[7] AS transcript, p[11] AS hgvs_p, p[9] AS rank, p[3] AS impact,
  CASE WHEN p[8] <> 'protein_coding' THEN 'other' WHEN list_has_any(string_split(p[2], '&'), {fn.LOF_EFFECTS}) THEN 'lof'
       WHEN p[3] IN ('HIGH', 'MODERATE') THEN 'protein_altering' ELSE 'other' END AS effect_class FROM e WHERE len(p) >= 11)
SELECT id, gene, transcript, effect_class, TRY_CAST(nullif(regexp_extract(hgvs_p, '^p\\.[A-Za-z]{{3}}(\\d+)', 1), '') AS BIGINT) AS protein_pos,
  split_part(rank, '/', 1) = split_part(rank, '/', 2) AS last_exon
FROM (SELECT *, row_number() OVER (PARTITION BY id, gene ORDER BY CASE effect_class WHEN 'lof' THEN 0 WHEN 'protein_altering' THEN 1 ELSE 2 END,
  CASE impact WHEN 'HIGH' THEN 0 WHEN 'MODERATE' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END, transcript) AS n FROM f) WHERE n = 1""")
def ann_best(spark, sf_dir):
    """The INFO text of every variant, its annotations, and the best of each gene."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    v = table(spark, sf_dir, "lineitem").select(*key).distinct()  # numbers meet, not the texts that follow from them
    return best_annotations(v.select(F.concat_ws("-", *key).alias("id"), F.expr(_INFO).alias("info")), repeats=False).select("id", "gene", "transcript", "effect_class", "protein_pos", "last_exon")


def best_annotations(variants, repeats=True):
    """Of (id, info) the best annotation of each variant and gene: class, then impact, then transcript.

    A row's own annotations are compared within the row.  Only if ids may have more rows
    than one (``repeats``) are the best of rows shuffled to be compared by id.
    """

    classes = F.array(*[F.lit(c) for c in ("lof", "protein_altering", "other")])

    def keyed(x):
        place = F.array_position(classes, fn.effect_class(x["effects"], x["biotype"], x["impact"])).cast("int")
        return F.struct(x["gene"].alias("gene"), place.alias("class"), (-fn.impact_rank(x["impact"])).alias("severity"), x["transcript"].alias("transcript"), x.alias("a"))

    def firsts(xs):  # in order of gene, so the first of a gene follows another one
        return F.filter(xs, lambda x, i: (i == 0) | ~x["gene"].eqNullSafe(F.get(xs, i - 1)["gene"]))

    ordered = F.array_sort(F.transform(fn.annotations(fn.info_value(F.col("info"), "ANN")), keyed))
    best = variants.select("id", F.explode(F.transform(F.array(ordered), firsts)[0]).alias("x"))
    if repeats:
        order = ["x.class", "x.severity", "x.transcript"]
        best = ops.best_on(best.withColumn("gene", F.col("x.gene")), ["id", "gene"], *[F.col(c).asc_nulls_first() for c in order])
    best = best.select("id", "x.a.*", F.get(classes, F.col("x.class") - 1).alias("effect_class"))
    return best.select("*", fn.protein_position(F.col("hgvs_p")).cast("bigint").alias("protein_pos"), fn.last_exon(F.col("rank")).alias("last_exon"))


#: Line items stand for alleles, parts for genes: genes grow in number with the table, not in size.
_HITS = """h AS (SELECT 'G' || l_partkey AS gene, l_orderkey * 10 + l_linenumber AS id, l_returnflag = 'R' AS lof, l_linestatus = 'F' AS passing,
  CASE WHEN l_discount = 0 THEN 'hom_alt' ELSE 'het' END AS zyg, l_tax > 0.04 AS mane, l_partkey % 3 = 0 AS altering,
  l_suppkey % 5 AS pid, l_linenumber % 2 AS pgt FROM lineitem)"""


def _hits(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('G', l_partkey) AS gene", "l_orderkey * 10 + l_linenumber AS id", "l_returnflag = 'R' AS lof", "l_linestatus = 'F' AS passing",
        "CASE WHEN l_discount = 0 THEN 'hom_alt' ELSE 'het' END AS zyg", "l_tax > 0.04 AS mane", "l_partkey % 3 = 0 AS altering", "l_suppkey % 5 AS pid", "l_linenumber % 2 AS pgt",
    )


_CONFIGS = f"""WITH {_HITS}, p AS (SELECT * FROM h WHERE passing), l AS (SELECT * FROM p WHERE lof), a AS (SELECT * FROM p WHERE NOT lof AND altering), c AS (
  SELECT gene, CASE WHEN mane THEN 0 ELSE 1 END AS rank, id AS a_id, CAST(NULL AS BIGINT) AS b_id, 'homozygous' AS phase FROM l WHERE zyg = 'hom_alt'
  UNION ALL SELECT x.gene, CASE WHEN x.mane AND y.mane THEN 0 ELSE 1 END, x.id, y.id, CASE WHEN x.pid = y.pid THEN 'trans' ELSE 'unphased' END
    FROM l x JOIN l y ON x.gene = y.gene AND x.id < y.id WHERE x.zyg = 'het' AND y.zyg = 'het' AND NOT (x.pid = y.pid AND x.pgt = y.pgt)
  UNION ALL SELECT x.gene, 2, x.id, y.id, CASE WHEN y.zyg = 'hom_alt' OR x.pid = y.pid THEN 'trans' ELSE 'unphased' END
    FROM l x JOIN a y ON x.gene = y.gene WHERE x.zyg = 'het' AND (y.zyg = 'hom_alt' OR NOT (x.pid = y.pid AND x.pgt = y.pgt)))"""


def _configurations(spark, sf_dir):
    """Homozygous, paired and mixed configurations of each gene's passing hits."""
    p = _hits(spark, sf_dir).filter("passing")
    lof, altering = p.filter("lof"), p.filter("NOT lof AND altering")
    hom = lof.filter("zyg = 'hom_alt'").select("gene", F.when(F.col("mane"), 0).otherwise(1).alias("rank"), F.col("id").alias("a_id"), F.lit(None).cast("bigint").alias("b_id"), F.lit("homozygous").alias("phase"))
    het = lof.filter("zyg = 'het'")

    def phase():
        return fn.phase(F.lit(False), F.col("a.pid"), F.col("b.pid"), F.col("a.pgt"), F.col("b.pgt"))

    pairs = ops.pairs_within(het, "gene", "id").withColumn("phase", phase()).filter("phase <> 'cis'")
    pairs = pairs.select("gene", F.when(F.col("a.mane") & F.col("b.mane"), 0).otherwise(1).alias("rank"), F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), "phase")
    mixed = het.select("gene", F.struct("*").alias("a")).join(altering.select("gene", F.struct("*").alias("b")), "gene")
    mixed = mixed.withColumn("phase", F.when(F.col("b.zyg") == "hom_alt", "trans").otherwise(phase())).filter("phase <> 'cis'")
    mixed = mixed.select("gene", F.lit(2).alias("rank"), F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), "phase")
    return p, hom.unionByName(pairs).unionByName(mixed)


_KIND = "CASE rank WHEN 0 THEN 'biallelic_lof' WHEN 1 THEN 'biallelic_lof_non_mane' ELSE 'lof_plus_protein_altering' END"


_PAIRS_SQL = f"SELECT gene, {_KIND} AS kind, phase, count(*) AS n FROM c GROUP BY ALL"
_VERDICT_SQL = f""", g AS (SELECT gene, count(*) AS n_pass, count(*) FILTER (WHERE lof) AS n_lof FROM p GROUP BY gene), b AS (SELECT gene, min(rank) AS rank, count(*) AS n FROM c GROUP BY gene)
SELECT gene, n_pass, n_lof, coalesce(n, 0) AS n_configurations, CASE WHEN rank IS NOT NULL THEN {_KIND} WHEN n_lof > 0 THEN 'monoallelic_lof' ELSE 'no_lof' END AS verdict FROM g LEFT JOIN b USING (gene)"""


def _pairs(configs):
    return configs.selectExpr("gene", f"{_KIND} AS kind", "phase").groupBy("gene", "kind", "phase").agg(F.count("*").alias("n"))


def _verdicts(p, configs):
    counts = p.groupBy("gene").agg(F.count("*").alias("n_pass"), F.count_if("lof").alias("n_lof"))
    best = configs.groupBy("gene").agg(F.min("rank").alias("rank"), F.count("*").alias("n"))
    return counts.join(best, "gene", "left").selectExpr("gene", "n_pass", "n_lof", "coalesce(n, 0) AS n_configurations", f"CASE WHEN rank IS NOT NULL THEN {_KIND} WHEN n_lof > 0 THEN 'monoallelic_lof' ELSE 'no_lof' END AS verdict")


@query(f"{_CONFIGS} {_PAIRS_SQL}")
def biallelic_pairs(spark, sf_dir):
    return _pairs(_configurations(spark, sf_dir)[1])


@query(f"{_CONFIGS}{_VERDICT_SQL}")
def gene_verdict(spark, sf_dir):
    return _verdicts(*_configurations(spark, sf_dir))


@query("""WITH x AS (SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'hemizygous' WHEN l_linenumber % 2 = 0 THEN 'hom_alt' ELSE 'het' END AS zygosity,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'mane_select' WHEN l_returnflag = 'R' THEN 'non_mane' ELSE 'not_lof' END AS tier, 'chr' || (l_suppkey % 3) AS contig FROM lineitem)
SELECT contig, zygosity, tier, count(*) AS n FROM x GROUP BY ALL""")
def zygosity_tiers(spark, sf_dir):
    n = F.col("l_linenumber")
    gt = F.when(n % 3 == 0, F.array(F.lit(1))).when(n % 2 == 0, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))
    lof = F.col("l_returnflag") == "R"
    contig = fn.prefixed_contig(F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit("chr"), F.col("l_suppkey") % 3)).otherwise((F.col("l_suppkey") % 3).cast("string")))
    rows = table(spark, sf_dir, "lineitem").select(contig.alias("contig"), fn.zygosity(gt).alias("zygosity"), fn.lof_tier(lof & (F.col("l_linestatus") == "F"), lof).alias("tier"))
    return rows.groupBy("contig", "zygosity", "tier").agg(F.count("*").alias("n"))
