"""Document, triage and guard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexical as fn
from ..functions.scan import names_of
from ..operators import harmonize, triage
from .registry import query, table

#: Phrases of the shipped tables, added to the invented texts so that every bucket is met.
TAILS = [" It is selectively toxic.", " The agent is clastogenic.", " Growth was strongly inhibited; antiproliferative.", " Licensed here under terms.", " Sensitivity licensed under test.", ""]
TAIL = "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(TAILS)) + " END"
WEIGHTS = {"clinical": 1.0, "in_vivo": 0.7, "in_vitro": 0.45, "ungraded": 0.2}


def _names_sql(patterns):
    cases = ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{n}' END" for n, p in patterns)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


@query("""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS x FROM documents)
SELECT doc_id, bool_or(regexp_matches(x, '(?i)licensed') AND regexp_matches(x, '(?i)under')) AS cooccur, count(*) AS n_sentences FROM s GROUP BY doc_id""")
def doc_cooccurrence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", fn.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", fn.cooccur(F.col("s"), fn.term_pattern("licensed"), fn.term_pattern("under")).alias("cooccur"), F.size("s").cast("bigint").alias("n_sentences"))


_DIRECTION = f"""WITH t AS (SELECT doc_id, source, coalesce(text, '') || {TAIL} AS text FROM documents),
d AS (SELECT doc_id, source, {_names_sql(fn.SUPPORT)} AS support, {_names_sql(fn.ADVERSE)} AS adverse FROM t),
w AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT d.doc_id, source, array_to_string(support, '|') AS support, array_to_string(adverse, '|') AS adverse,
 CASE WHEN coalesce(toxic, 0) = 1 THEN 'withdrawn' WHEN len(adverse) > 0 THEN 'adverse_direction' WHEN len(support) = 0 THEN 'no_direction_phrase' ELSE 'supporting' END AS bucket FROM d LEFT JOIN w USING (doc_id))"""


def read_texts():
    """One pass over a text finds the names of both tables, and whether one sentence has both terms."""
    text = F.concat(F.coalesce("text", F.lit("")), F.expr(TAIL))
    return names_of(text, {"support": fn.SUPPORT, "adverse": fn.ADVERSE}, {"cooccurs": (fn.term_pattern("licensed"), fn.term_pattern("under"))})


def _directed(spark, sf_dir):
    w = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    d = table(spark, sf_dir, "documents").select("doc_id", "source", read_texts().alias("x")).select("doc_id", "source", "x.support", "x.adverse")
    bucket = (
        F.when(F.coalesce("toxic", F.lit(0)) == 1, "withdrawn")
        .when(F.size("adverse") > 0, "adverse_direction")
        .when(F.size("support") == 0, "no_direction_phrase")
        .otherwise("supporting")
    )
    return d.join(w, "doc_id", "left").withColumn("bucket", bucket)


@query(f"{_DIRECTION} SELECT doc_id, support, adverse, bucket FROM c")
def doc_direction(spark, sf_dir):
    return _directed(spark, sf_dir).select("doc_id", F.array_join("support", "|").alias("support"), F.array_join("adverse", "|").alias("adverse"), "bucket")


@query(f"{_DIRECTION} SELECT bucket, count(*) AS n FROM c GROUP BY bucket")
def doc_buckets(spark, sf_dir):
    return _directed(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"))


_GRADE = "CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'clinical' WHEN source IN ('src3', 'src4') THEN 'in_vivo' WHEN source IN ('src5', 'src6', 'src7', 'src8') THEN 'in_vitro' ELSE 'ungraded' END"


def _indexed(docs):
    """Sources stand for the terms a record is indexed by."""
    types = F.when(F.col("source").isin("src0", "src1"), F.array(F.lit("Randomized Controlled Trial"))).otherwise(F.array(F.lit("Letter")))
    terms = (
        F.when(F.col("source") == "src2", F.array(F.lit("Treatment Outcome"), F.lit("Mice")))
        .when(F.col("source").isin("src3", "src4"), F.array(F.lit("Mice"), F.lit("Fibroblasts")))
        .when(F.col("source").isin("src5", "src6", "src7", "src8"), F.array(F.lit("Cells, Cultured")))
        .otherwise(F.array(F.lit("Language")))
    )
    return docs.withColumn("grade", fn.grade(types, terms))


@query(f"SELECT doc_id, {_GRADE} AS grade FROM documents")
def doc_grade(spark, sf_dir):
    return _indexed(table(spark, sf_dir, "documents").select("doc_id", "source")).select("doc_id", "grade")


@query(f"""{_DIRECTION}, g AS (SELECT lang, {_GRADE} AS grade FROM c JOIN documents USING (doc_id, source) WHERE bucket = 'supporting')
SELECT lang, count(*) FILTER (WHERE grade = 'clinical') AS n_clinical, count(*) FILTER (WHERE grade = 'in_vivo') AS n_in_vivo, count(*) FILTER (WHERE grade = 'in_vitro') AS n_in_vitro, count(*) FILTER (WHERE grade = 'ungraded') AS n_ungraded,
 round(sum(CASE grade WHEN 'clinical' THEN 1.0 WHEN 'in_vivo' THEN 0.7 WHEN 'in_vitro' THEN 0.45 ELSE 0.2 END), 4) AS score FROM g GROUP BY lang""")
def doc_score(spark, sf_dir):
    langs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    g = _indexed(_directed(spark, sf_dir).filter("bucket = 'supporting'")).join(langs, "doc_id")
    weight = F.lit(0.0)
    for name, w in WEIGHTS.items():
        weight = F.when(F.col("grade") == name, w).otherwise(weight)
    counts = [F.count_if(F.col("grade") == n).alias(f"n_{n}") for n in fn.GRADES]
    return g.groupBy("lang").agg(*counts, F.round(F.sum(weight), 4).alias("score"))


@query("""WITH b AS (SELECT doc_id % 400 AS key, 'curated' AS origin, doc_id AS ord FROM documents WHERE source = 'src3' UNION ALL SELECT doc_id % 400, 'retrieved', doc_id FROM documents WHERE source <> 'src3')
SELECT key, origin, ord FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY origin, ord) AS n FROM b) WHERE n = 1""")
def doc_dedupe(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 400).alias("key"), F.col("doc_id").alias("ord"), "source")
    return harmonize.pooled(d.filter("source = 'src3'").drop("source"), d.filter("source <> 'src3'").drop("source"), "key").select("key", "origin", "ord")


#: Invented label sentences and their genotoxic verdicts' reasons.
LABELS = [
    ("L1", "Inventib was not mutagenic or clastogenic in vitro.", "Safety and effectiveness in pediatric patients have not been established."),
    ("L2", "Inventib was carcinogenic in rats.", "INVENTIB is indicated in pediatric patients 2 years and older."),
    ("L3", "Although no increase in tumors was seen at low dose, the drug was clastogenic.", "INVENTIB is not indicated in pediatric patients."),
    ("L4", "Inventib was negative in the Ames assay but was clastogenic in human lymphocytes.", ""),
    ("L5", "The section reports nothing.", "The safety and effectiveness of INVENTIB have been established in pediatric patients 1 year of age and older."),
    ("L6", "No evidence of carcinogenicity was observed. Inventib was not carcinogenic.", "Safety and effectiveness have not been established in pediatric patients 6 years of age and older."),
]


_LABELS = f"""lab(k, finding, pediatric) AS (VALUES {', '.join(f"({k}, '{g}', '{p}')" for k, (_, g, p) in enumerate(LABELS))}),
d AS (SELECT doc_id, doc_id % 7 <> 3 AS labelled, CASE WHEN doc_id % 7 <> 3 THEN trim(finding || ' ' || coalesce(text, '')) END AS finding, CASE WHEN doc_id % 7 <> 3 THEN nullif(trim(pediatric), '') END AS pediatric,
  CASE WHEN doc_id % 7 <> 3 AND doc_id % 5 = 0 THEN 'There is an increased risk of lymphoma.' END AS boxed, CASE doc_id % 4 WHEN 0 THEN 'Prescription' WHEN 1 THEN 'Discontinued' WHEN 2 THEN 'Over-the-counter' END AS status,
  CASE WHEN doc_id % 11 = 0 THEN 'Alkylating Drug' ELSE 'Kinase Inhibitor' END AS class FROM documents JOIN lab ON k = doc_id % 6)"""


def _free_sql(text: str, patterns, masks) -> str:
    """The first pattern with a match whose start lies in no mask's span: places from the pieces between matches."""

    def spans(p):
        p = "(?i)" + p.replace("'", "''")
        between, found = f"string_split_regex({text}, '{p}')", f"regexp_extract_all({text}, '{p}')"
        start = f"CAST(coalesce(list_sum(list_transform({between}[1:i], lambda v: length(v))), 0) + coalesce(list_sum(list_transform({found}[1:i - 1], lambda v: length(v))), 0) AS BIGINT)"
        return f"list_transform(range(1, len({found}) + 1), lambda i: [{start}, {start} + length({found}[i])])"

    covered = "flatten([" + ", ".join(map(spans, masks)) + "])"
    cases = " ".join(f"WHEN regexp_matches({text}, '(?i){p}') AND len(list_filter({spans(p)}, lambda m: len(list_filter({covered}, lambda c: c[1] <= m[1] AND m[1] < c[2])) = 0)) > 0 THEN '{n}'" for n, p in patterns)
    return f"CASE {cases} END"


_TRIAGE = f"""WITH {_LABELS}, g AS (SELECT *, CASE WHEN regexp_matches(class, '(?i){'|'.join(fn.CYTOTOXIC_CLASSES)}') THEN 'cytotoxic_class' WHEN warned IS NOT NULL THEN warned WHEN found IS NOT NULL THEN found
    WHEN coalesce(regexp_matches(finding, '(?i){'|'.join(fn.NEGATIVE)}'), false) THEN 'negative_findings_reported' ELSE 'insufficient_evidence' END AS geno
  FROM (SELECT *, {_free_sql('boxed', triage.RISK, fn.NEGATED)} AS warned, {_free_sql('finding', fn.GENOTOXIC, fn.NEGATED)} AS found,
    {_free_sql('pediatric', fn.PEDIATRIC_ESTABLISHED, [p for _, p in fn.PEDIATRIC_DENIED])} AS ok, {_free_sql('pediatric', fn.PEDIATRIC_DENIED, fn.NEGATED)} AS denied FROM d)),
v AS (SELECT doc_id, unnest([
  {{'rule': 'genotoxic_or_cancer_risk', 'verdict': CASE WHEN geno = 'negative_findings_reported' THEN 'pass' ELSE 'excluded' END, 'reason': geno}},
  {{'rule': 'pediatric_use', 'verdict': CASE WHEN ok IS NOT NULL THEN 'pass' ELSE 'excluded' END, 'reason': coalesce(ok, denied, 'insufficient_evidence')}},
  {{'rule': 'currently_marketed', 'verdict': CASE WHEN status IN ('Prescription', 'Over-the-counter') THEN 'pass' ELSE 'excluded' END, 'reason': CASE WHEN status IS NULL THEN 'insufficient_evidence' WHEN status = 'Discontinued' THEN 'not_currently_marketed' ELSE 'marketed' END}},
  {{'rule': 'bbb_penetration', 'verdict': 'not_applicable', 'reason': 'endpoint_has_no_cns_requirement'}},
  {{'rule': 'clinical_status', 'verdict': CASE WHEN labelled THEN 'pass' ELSE 'not_applicable' END, 'reason': CASE WHEN NOT labelled THEN 'no_label' WHEN boxed IS NOT NULL THEN 'boxed_warning_present' ELSE 'no_warning_sections' END}}], recursive := true) FROM g)"""


def _judged(spark, sf_dir):
    """Every document as a label: invented findings before its text, some without a label, status or class."""
    k = F.col("doc_id") % 6
    pick = lambda i: F.get(F.array(*[F.lit(x[i]) for x in LABELS]), k.cast("int"))
    sections = F.map_filter(
        F.create_map(
            F.lit(triage.FINDINGS[0]), F.trim(F.concat(pick(1), F.lit(" "), F.coalesce("text", F.lit("")))), F.lit("pediatric_use"), pick(2),
            F.lit("boxed_warning"), F.when(F.col("doc_id") % 5 == 0, "There is an increased risk of lymphoma."),
        ), lambda _, v: v.isNotNull(),
    )
    status = F.when(F.col("doc_id") % 4 == 0, "Prescription").when(F.col("doc_id") % 4 == 1, "Discontinued").when(F.col("doc_id") % 4 == 2, "Over-the-counter")
    labels = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 7 != 3, sections).alias("sections"), F.when(status.isNotNull(), F.array(status)).alias("statuses"),
        F.array(F.when(F.col("doc_id") % 11 == 0, "Alkylating Drug").otherwise("Kinase Inhibitor")).alias("classes"),
    )
    return triage.verdicts(labels)


@query(f"{_TRIAGE} SELECT doc_id, rule, verdict, reason FROM v")
def triage_verdicts(spark, sf_dir):
    return _judged(spark, sf_dir).select("doc_id", F.explode("verdicts").alias("v")).select("doc_id", "v.*")


@query(f"{_TRIAGE} SELECT rule, verdict, reason, count(*) AS n FROM v GROUP BY GROUPING SETS ((rule, verdict), (rule, reason))")
def triage_counts(spark, sf_dir):
    return triage.verdict_counts(_judged(spark, sf_dir))


@query(f"""{_TRIAGE} SELECT doc_id, coalesce(bool_and(verdict <> 'excluded') FILTER (WHERE rule IN ('genotoxic_or_cancer_risk', 'pediatric_use', 'currently_marketed')), true) AS survives,
 CASE min(CASE WHEN verdict = 'excluded' THEN CASE rule WHEN 'genotoxic_or_cancer_risk' THEN 1 WHEN 'pediatric_use' THEN 2 WHEN 'currently_marketed' THEN 3 END END) WHEN 1 THEN 'genotoxic_or_cancer_risk' WHEN 2 THEN 'pediatric_use' WHEN 3 THEN 'currently_marketed' END AS excluded_by FROM v GROUP BY doc_id""")
def triage_survivors(spark, sf_dir):
    return _judged(spark, sf_dir).select("doc_id", "survives", "excluded_by")


def _guards_sql(patterns):
    cases = ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in patterns)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


@query(f"""WITH m AS (SELECT conv_id, turn, regexp_replace(text || CASE conv_id % 4 WHEN 0 THEN ' rs123456' WHEN 1 THEN ' see 10.1158/0008-5472.CAN-13-1174' WHEN 2 THEN ' 7:1234567' ELSE '' END, '\\b10\\.\\d{{4,9}}/[^\\s"'')\\]]+', ' ', 'g') AS t FROM conversations)
SELECT conv_id, turn, array_to_string({_guards_sql([*fn.PRIVATE, *fn.REPORT])}, '|') AS broken FROM m""")
def publication_guard(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    tail = F.when(F.col("conv_id") % 4 == 0, " rs123456").when(F.col("conv_id") % 4 == 1, " see 10.1158/0008-5472.CAN-13-1174").when(F.col("conv_id") % 4 == 2, " 7:1234567").otherwise("")
    return c.select("conv_id", "turn", F.array_join(fn.forbidden(F.concat("text", tail)), "|").alias("broken"))


@query("""SELECT page_id, length(e) AS n_chars, md5(e) AS digest FROM (SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS e FROM pages)""")
def html_escape(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", fn.html_escape(F.col("html")).alias("e"))
    return p.select("page_id", F.length("e").cast("bigint").alias("n_chars"), F.md5("e").alias("digest"))


_PACKETS = """WITH p AS (SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'clinical' WHEN 1 THEN 'in_vivo' WHEN 2 THEN 'in_vitro' ELSE 'ungraded' END AS grade,
 p_retailprice > 975 AS supported, p_partkey % 5 = 0 AS contradicted, p_partkey % 3 AS n_adverse, p_partkey % 4 AS n_channels, p_partkey % 2 = 0 AS discriminating FROM part)"""


def _packets(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.selectExpr(
        "p_partkey AS id", "CASE p_size % 4 WHEN 0 THEN 'clinical' WHEN 1 THEN 'in_vivo' WHEN 2 THEN 'in_vitro' ELSE 'ungraded' END AS grade", "p_retailprice > 975 AS supported",
        "p_partkey % 5 = 0 AS contradicted", "p_partkey % 3 AS n_adverse", "p_partkey % 4 AS n_channels", "p_partkey % 2 = 0 AS discriminating",
    )


@query(f"""{_PACKETS} SELECT id, round(greatest(0, least(1, CAST(CASE grade WHEN 'clinical' THEN 1.0 WHEN 'in_vivo' THEN 0.7 WHEN 'in_vitro' THEN 0.45 ELSE 0.2 END AS DOUBLE) * CASE WHEN supported THEN 1 ELSE 0.4::DOUBLE END
 * CASE WHEN contradicted THEN 0.6::DOUBLE ELSE 1 END * CASE WHEN n_adverse > 0 THEN 0.7::DOUBLE ELSE 1 END * CASE WHEN n_channels < 2 THEN 1 WHEN discriminating THEN 1.25::DOUBLE ELSE 1.05::DOUBLE END)), 3) AS confidence FROM p""")
def confidence(spark, sf_dir):
    c = [F.col(x) for x in ("grade", "supported", "contradicted", "n_adverse", "n_channels", "discriminating")]
    return _packets(spark, sf_dir).select("id", fn.confidence(*c).alias("confidence"))


@query(f"{_PACKETS} SELECT CASE WHEN n_channels > 0 AND grade <> 'ungraded' THEN 'supported' ELSE 'hypothesis' END AS tier, grade, count(*) AS n FROM p GROUP BY ALL")
def evidence_tier(spark, sf_dir):
    tier = F.when((F.col("n_channels") > 0) & (F.col("grade") != "ungraded"), "supported").otherwise("hypothesis")
    return _packets(spark, sf_dir).groupBy(tier.alias("tier"), "grade").agg(F.count("*").alias("n"))


@query("""WITH g AS (SELECT o_orderkey AS id, [' PMID:' || (o_custkey % 9), 'pmid:' || (o_custkey % 9), 'DOI:' || (o_orderkey % 5), 'x'] AS given FROM orders),
k AS (SELECT id, unnest(given) AS v, unnest(range(4)) AS ord FROM g), d AS (SELECT id, lower(trim(v)) AS v, min(ord) AS ord FROM k GROUP BY ALL)
SELECT id, coalesce(string_agg(v, '|' ORDER BY ord) FILTER (WHERE v IN ('pmid:1', 'pmid:4', 'doi:2')), '') AS kept, coalesce(string_agg(v, '|' ORDER BY ord) FILTER (WHERE v NOT IN ('pmid:1', 'pmid:4', 'doi:2')), '') AS dropped FROM d GROUP BY id""")
def citation_validate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    given = F.array(F.concat(F.lit(" PMID:"), F.col("o_custkey") % 9), F.concat(F.lit("pmid:"), F.col("o_custkey") % 9), F.concat(F.lit("DOI:"), F.col("o_orderkey") % 5), F.lit("x"))
    allowed = F.array(F.lit("pmid:1"), F.lit("PMID:4"), F.lit("doi:2"))
    v = o.select(F.col("o_orderkey").alias("id"), fn.valid_citations(given, allowed).alias("v"))
    return v.select("id", F.array_join("v.kept", "|").alias("kept"), F.array_join("v.dropped", "|").alias("dropped"))


#: Orders as rows of a submission, many of them wrong.
_SUBMITTED = """o_orderkey AS row, {chr} AS contig, CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_custkey % 40 AS {text}) END AS pos, CASE o_orderkey % 13 WHEN 0 THEN 'N' WHEN 1 THEN 'GA' ELSE 'A' END AS ref,
CASE o_custkey % 7 WHEN 0 THEN 'A' WHEN 1 THEN '' ELSE 'T' END AS alt, CASE WHEN o_orderkey % 17 = 0 THEN '0' WHEN o_orderkey % 19 = 0 THEN 'one' ELSE CAST(1 - (o_orderkey % 100) / 100.0 AS {text}) END AS epcr"""


@query(f"""WITH s AS (SELECT {_SUBMITTED.format(text="VARCHAR", chr="'chr' || (o_custkey % 26)")} FROM orders), n AS (SELECT *, TRY_CAST(epcr AS DOUBLE) AS e, lag(TRY_CAST(epcr AS DOUBLE)) OVER (ORDER BY row) AS before, count(*) OVER (PARTITION BY contig, pos, ref, alt ORDER BY row) AS nth FROM s)
SELECT CAST(row AS BIGINT) AS row, unnest(list_filter([CASE WHEN NOT regexp_matches(contig, '^chr([1-9]|1[0-9]|2[0-2]|X|Y|MT)$') THEN 'contig' END, CASE WHEN TRY_CAST(pos AS BIGINT) IS NULL THEN 'position' END,
 CASE WHEN NOT regexp_matches(ref, '^[ACGT]+$') OR NOT regexp_matches(alt, '^[ACGT]+$') THEN 'bases' END, CASE WHEN ref = alt THEN 'same' END, CASE WHEN NOT (e > 0 AND e <= 1) THEN 'range' END, CASE WHEN e > before THEN 'order' END, CASE WHEN nth > 1 THEN 'duplicate' END], lambda x: x IS NOT NULL)) AS code FROM n""")
def submission_check(spark, sf_dir):
    from ..sources.submission import violations

    return violations(table(spark, sf_dir, "orders").selectExpr(*_columns(_SUBMITTED.format(text="STRING", chr="concat('chr', o_custkey % 26)"))))


def _columns(select: str) -> list[str]:
    """Expressions of a SELECT list: cut at the commas outside brackets."""
    out, depth = [""], 0
    for c in select:
        depth += (c == "(") - (c == ")")
        out[-1] += c
        if c == "," and not depth:
            out[-1] = out[-1][:-1]
            out.append("")
    return [x.strip() for x in out]


@query("""SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderpriority = '1-URGENT'""")
def withheld_fields(spark, sf_dir):
    """Only listed fields leave: everything else is dropped by name."""
    from ..sources.sinks import publishable

    o = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").withColumnsRenamed({"o_orderkey": "id", "o_orderstatus": "status"})
    return publishable(o, ["id", "status"])
