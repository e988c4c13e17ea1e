"""Queries against their SQL, and vectors of single operators."""

import ast
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from lodestone.functions import alleles, burden, lexical
from lodestone.operators import graph, harmonize, intervals, ranking, records, signatures, triage
from lodestone.plans import registry
from tests.compare import differences

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(spark, registry.QUERIES[name], registry.ORACLES[name], sf_dir) == ""


def test_queries_cover_their_tables(spark, sf_dir):
    def of(name):
        return registry.QUERIES[name](spark, sf_dir)

    li, part = registry.table(spark, sf_dir, "lineitem"), registry.table(spark, sf_dir, "part")
    assert of("gene_verdict").agg(F.sum("n_pass")).first()[0] == li.filter("l_linestatus = 'F'").count()
    assert of("biallelic_pairs").agg(F.sum("n")).first()[0] == of("gene_verdict").agg(F.sum("n_configurations")).first()[0]
    assert of("crosswalk_fallback").select("key").distinct().count() == part.count()
    inside = of("interval_join").select("id").distinct().count()
    assert of("outside_regions").count() + inside == registry.table(spark, sf_dir, "orders").count()


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["key", "score", "p", "n_support", "convergence"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_corpus_operators_are_optional():
    for path in (ROOT / "lodestone").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any("llm" in n.split(".") for n in names), path


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("f", [0.1, 0.25, 0.5, 0.75, 1.0])
def test_mosaic_fraction_inverts_the_models(spark, f):
    assert _one(spark, burden.mosaic_fraction(F.lit(f / (2 * (2 + f))), True)) == pytest.approx(f)
    assert _one(spark, burden.mosaic_fraction(F.lit(f / (2 * (2 - f))), False)) == pytest.approx(f)


def test_burden_vectors(spark):
    assert _one(spark, burden.mosaic_fraction(F.lit(1 / 6), True)) == pytest.approx(1.0)
    assert _one(spark, burden.mosaic_fraction(F.lit(0.30), True)) is None
    assert [_one(spark, burden.baf(F.lit(a), F.lit(b))) for a, b in ((0, 0), (10, 10), (0, 20))] == [None, 0.5, 1.0]
    assert [_one(spark, burden.contamination(F.lit(x))) for x in (0.20, 0.07, 0.0)] == ["suspect", "clean", "unknown"]
    import math

    for z in (0.0, 0.3, 1.0, 2.5, 5.9):
        assert _one(spark, burden.erf(F.lit(z))) == pytest.approx(math.erf(z), abs=1e-13)
    for d in (0.02, 0.1, 0.3):
        s = F.lit(0.5 / 44**0.5)
        assert _one(spark, burden.deconvolve_shift(burden.folded_mean(F.lit(d), s), s)) == pytest.approx(d, abs=1e-6)
    assert _one(spark, burden.deconvolve_shift(F.lit(0.01), F.lit(0.07))) == 0.0
    assert _one(spark, burden.deconvolve_shift(F.lit(0.6), F.lit(0.07))) is None


def test_allele_vectors(spark):
    assert _one(spark, alleles.phase(F.lit(True), F.lit(None), F.lit(None), F.lit(None), F.lit(None))) == "trans"
    assert _one(spark, alleles.phase(F.lit(False), F.lit("a"), F.lit("a"), F.lit("0|1"), F.lit("1|0"))) == "trans"
    assert _one(spark, alleles.phase(F.lit(False), F.lit("a"), F.lit("a"), F.lit("0|1"), F.lit("0|1"))) == "cis"
    assert _one(spark, alleles.phase(F.lit(False), F.lit("a"), F.lit(None), F.lit("0|1"), F.lit("0|1"))) == "unphased"
    assert _one(spark, alleles.info_map(F.lit("A=1;FLAG;B=x=y;A=2"))) == {"A": "2", "B": "x=y"}
    with pytest.raises(Exception, match="loss of function"):
        _one(spark, alleles.lof_tier(F.lit(True), F.lit(False)))


GENOTOXIC = [
    ("Inventib was not mutagenic or clastogenic in vitro.", None),
    ("No evidence of carcinogenicity was observed.", None),
    ("Inventib was not carcinogenic, mutagenic, or clastogenic.", None),
    ("Inventib was carcinogenic in rats.", "carcinogenic_finding"),
    ("Treatment increased the incidence of hepatic tumors in mice.", "increased_tumours"),
    ("Inventib was negative in the Ames assay but was clastogenic in human lymphocytes.", "clastogenic_finding"),
    ("There is an increased risk of secondary malignancies.", "malignancy_risk"),
    ("Patients with non-Hodgkin lymphoma had an increased risk of secondary malignancies.", "malignancy_risk"),
    ("Although no increase in tumors was seen at low dose, the drug was clastogenic.", "clastogenic_finding"),
    ("In non-clinical studies the compound was clastogenic.", "clastogenic_finding"),
    ("Inventib, which has no effect on fertility, was carcinogenic in mice.", "carcinogenic_finding"),
    (None, None),
]


def test_negation_covers_only_its_span(spark):
    rows = [(k, {"nonclinical_toxicology": t} if t else {}, [], []) for k, (t, _) in enumerate(GENOTOXIC)]
    labels = spark.createDataFrame(rows, "k int, sections map<string,string>, statuses array<string>, classes array<string>")
    got = triage.verdicts(labels).orderBy("k").collect()
    reasons = [next(v.reason for v in r.verdicts if v.rule == "genotoxic_or_cancer_risk") for r in got]
    assert [x if x not in ("negative_findings_reported", "insufficient_evidence") else None for x in reasons] == [w for _, w in GENOTOXIC]


PEDIATRIC = [
    ("Safety and effectiveness in pediatric patients have not been established.", "excluded", "safety_not_established"),
    ("The safety and effectiveness of INVENTIB have been established in pediatric patients 1 year of age and older.", "pass", "established"),
    ("Safety and effectiveness have not been established in pediatric patients 6 years of age and older.", "excluded", "safety_not_established"),
    ("INVENTIB is indicated in pediatric patients 2 years and older.", "pass", "indicated_in_children"),
    ("INVENTIB is not indicated in pediatric patients.", "excluded", "not_indicated"),
    (None, "excluded", "insufficient_evidence"),
]


def test_gates_fail_closed(spark):
    rows = [(str(k), {"pediatric_use": t} if t else {}, ["Prescription"], []) for k, (t, _, _) in enumerate(PEDIATRIC)] + [("none", None, None, None)]
    labels = spark.createDataFrame(rows, "id string, sections map<string,string>, statuses array<string>, classes array<string>")
    got = {r.id: {v.rule: (v.verdict, v.reason) for v in r.verdicts} | {"survives": r.survives, "by": r.excluded_by} for r in triage.verdicts(labels).collect()}
    for k, (_, verdict, reason) in enumerate(PEDIATRIC):
        assert got[str(k)]["pediatric_use"] == (verdict, reason)
    assert got["none"]["by"] == "genotoxic_or_cancer_risk" and not got["none"]["survives"]
    assert got["none"]["currently_marketed"] == ("excluded", "insufficient_evidence")
    full = {triage.FINDINGS[0]: "Inventib was not carcinogenic.", "pediatric_use": PEDIATRIC[1][0]}
    one = triage.verdicts(spark.createDataFrame([("x", full, ["Over-the-counter"], ["Kinase Inhibitor"])], labels.schema)).first()
    assert one.survives and one.excluded_by is None


def test_rank_aggregation_vectors(spark):
    def run(channels, n):
        rows = [(c, k, p) for c, keys in channels.items() for p, k in enumerate(keys, 1)]
        return {r.key: r for r in ranking.aggregate(spark.createDataFrame(rows, "channel string, key string, position long"), n).collect()}

    wide = [f"INV{k}" for k in range(10)]
    assert run({"wide": wide, "narrow": ["INV0"]}, 2)["INV0"].convergence == "mixed"
    got = run({"a": ["INV0", "INV1"], "b": ["INV0", "INV2"], "wide": wide}, 3)
    assert (got["INV0"].convergence, got["INV1"].convergence) == ("discriminating", "mixed")
    assert {r.convergence for r in run({"a": wide, "b": wide}, 2).values()} == {"broad_only"}
    assert {r.convergence for r in run({"a": wide}, 1).values()} == {"none"}


@pytest.mark.parametrize(("positives", "n", "want"), [([1, 2, 3], 10, 1.0), ([8, 9, 10], 10, 0.0), ([1, 2], 2, None)])
def test_auroc_vectors(spark, positives, n, want):
    df = spark.createDataFrame([(p, p in positives) for p in range(1, n + 1)], "position long, is_positive boolean")
    assert ranking.auroc(df).first().auroc == want


def test_bootstrap_of_one_positive_has_no_interval(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, False)], "position long, is_positive boolean")
    r = ranking.bootstrap(df, 50, 1).first()
    assert r.lo is None and r.hi is None


def test_bootstrap_deals_its_draws_over_tasks(spark):
    rows = [(p, p % 3 == 0) for p in range(1, 61)]
    ranked = spark.createDataFrame(rows, "position long, is_positive boolean").coalesce(1)
    df = ranking.bootstrap(ranked, 40, 7)
    fractions = [(40 - (p - i)) / 40 for i, p in enumerate(range(3, 61, 3), 1)]
    means = sorted(sum(fractions[int(hashlib.md5(f"7|{s}|{i}".encode()).hexdigest()[:8], 16) % 20] for i in range(1, 21)) / 20 for s in range(40))
    r = df.first()
    assert (r.lo, r.hi, r.n_positives) == (pytest.approx(means[0], abs=6e-5), pytest.approx(means[38], abs=6e-5), 20)
    assert "Range (0, 800, step=1, splits=" in df._jdf.queryExecution().executedPlan().toString()
    none = ranking.bootstrap(ranked.filter("NOT is_positive"), 40, 7).collect()
    assert [(x.lo, x.hi, x.n_positives) for x in none] == [(None, None, 0)]


def test_graph_vectors(spark):
    pairs = [("P0", "P1", 950), ("P0", "P2", 920), ("P1", "P2", 900), ("P0", "P3", 800), ("P3", "P4", 750), ("P4", "P5", 720), ("P5", "P6", 400), ("P8", "P9", 990), ("P0", "P0", 999)]
    sym = graph.both_ways(graph.build_edges(spark.createDataFrame(pairs, "a string, b string, score int"), 700))
    assert {r.node for r in graph.seeds(sym, "P0", 900).collect()} == {"P0", "P1", "P2"}
    assert {r.node for r in graph.largest_component(sym).collect()} == {"P0", "P1", "P2", "P3", "P4", "P5"}
    with pytest.raises(ValueError):
        graph.seeds(sym, "P7", 900)
    line = spark.createDataFrame([(f"n{k}", f"n{k + 1}", 1.0) for k in range(5)], "a string, b string, score double")
    ends = spark.createDataFrame([("n0",), ("n5",)], "node string")
    assert {r.node: r.distance for r in graph.bfs_distances(graph.both_ways(line), ends).collect()} == dict(zip([f"n{k}" for k in range(6)], [0, 1, 2, 2, 1, 0]))
    walk = graph.random_walk(sym, graph.seeds(sym, "P0", 900), 0.7, 200, 1e-10)
    assert sum(r.score for r in walk.collect()) == pytest.approx(1.0, abs=1e-8)


def test_harmonize_vectors(spark):
    up = spark.createDataFrame([("C3", "C2"), ("C2", "C1"), ("C1", None), ("X", "Y"), ("Y", "X")], "id string, parent string")
    got = {r.id: r.root for r in graph.resolve_parents(up).collect()}
    assert got["C3"] == got["C2"] == got["C1"] == "C1" and set(got) == {"C1", "C2", "C3", "X", "Y"}
    sets = spark.createDataFrame([("C1", "Inventib hydrochloride", ["1", "2"]), ("C2", "Inventib", ["2", "1"]), ("C3", "Other", ["1"]), ("C4", "", []), ("C5", "e", None)], "key string, name string, members array<string>")
    assert {r.key: r.survivor for r in harmonize.merge_identical_sets(sets).collect()} == {"C1": "C2", "C2": "C2", "C3": "C3", "C4": "C4", "C5": "C5"}


def test_signature_vectors(spark):
    up, down = [0, 1, 2], [17, 18, 19]
    z = {"match": [3.0] * 3 + [0.0] * 14 + [-3.0] * 3, "reverse": [-3.0] * 3 + [0.0] * 14 + [3.0] * 3, "together": [3.0] * 3 + [0.0] * 14 + [3.0] * 3, "flat": [0.0] * 20}
    ranks = signatures.ranked(spark.createDataFrame([(k, 1, v) for k, v in z.items()], "sig string, grp int, z array<double>"))
    tails = spark.createDataFrame([(1, "up", g) for g in up] + [(1, "down", g) for g in down], "query int, tail string, gene int")
    got = {r.sig: r.wtcs for r in signatures.connectivity(ranks, tails).collect()}
    assert got["match"] > 0 > got["reverse"] and got["together"] == 0 and got["flat"] == 0


def test_partitioning_does_not_matter(spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name in ("proximity_z", "rra", "contig_rollup", "set_merge"):
            results = set()
            for n in ("1", "4", "13"):
                spark.conf.set("spark.sql.shuffle.partitions", n)
                results.add(str(sorted(map(str, registry.QUERIES[name](spark, sf_dir).collect()))))
            assert len(results) == 1, name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_guards(spark):
    def broken(t):
        return _one(spark, F.array_join(lexical.forbidden(F.lit(t)), ","))

    for t in ("HP:0001250", "7:1234567", "c.1234A>G", "MONDO:0008234", "karyotype: 47", "47,XY", "rs123456"):
        assert broken(t), t
    assert not broken("ordinary prose with 10.1158/0008-5472.CAN-13-1174")
    assert _one(spark, lexical.unqualified(F.lit("For chemoprevention."))) and not _one(spark, lexical.unqualified(F.lit("For secondary chemoprevention.")))
    assert _one(spark, lexical.confidence(F.lit("in_vitro"), F.lit(False), F.lit(False), F.lit(2), F.lit(2), F.lit(False))) == 0.132


def test_components_of_a_long_chain(spark):
    line = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(1.0).alias("score"))
    sym = graph.both_ways(line)
    for local in (graph.LOCAL_EDGES, 100):  # joined in one task, and contracted down to few edges
        got = graph.components(sym, local)
        assert got.count() == 10_001 and got.filter("component <> 0").isEmpty()


def test_record_vectors(spark):
    configs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, [])], "id int, members array<string>")
    got = {r.id: r.evidence for r in records.attach(configs, spark.createDataFrame([("a", 5)], "key string, value int")).collect()}
    assert got == {1: [None, 5, None], 2: [None]}
    assert [_one(spark, lexical.as_list(F.lit(x))) for x in (None, "a", "['a', 'b']", '["c"]')] == [[], ["a"], ["a", "b"], ["c"]]
    texts = spark.createDataFrame([("k", 2, "a warning"), ("k", 1, "a warning and more"), ("k", 3, "else"), ("k", 4, "else")], "key string, ord int, text string")
    assert records.merged_texts(texts).first().text == "a warning and more else"
    with pytest.raises(ValueError):
        records.gene_axis(texts.select(F.col("key").alias("gene"), F.col("ord").alias("place")), texts.selectExpr("'x' AS gene"), texts.selectExpr("key AS gene"))
    with pytest.raises(Exception, match="nothing is recorded for"):
        records.complete(texts.selectExpr("key AS id", "text"), spark.createDataFrame([("z",)], "id string"), "id").collect()
    with pytest.raises(Exception, match="wildcard"):
        _one(spark, lexical.search_query("T", F.array(F.lit("two words*")), ["x"]))
    rungs = spark.createDataFrame([(1, True), (10, False), (50, True), (250, False)], "depth int, passes boolean")
    assert records.deepest(rungs).first().depth == 50 and records.deepest(rungs.filter("NOT passes")).first().depth == 0
    assert _one(spark, lexical.snippet(F.lit("One.  Two is\n here, yes. Three"), "here")) == "Two is here, yes."
    points = spark.createDataFrame([(1, 1, 5), (1, 1, 5)], "id int, contig int, pos int")
    assert intervals.first_region(points, spark.createDataFrame([("g", 1, 0, 9)], "gene string, contig int, start int, end int"), 0).count() == 2
    limit = _one(spark, burden.detection_limit(F.lit(0.06), F.lit(0.004), F.lit(0.0754)))
    assert 0 < limit < 0.5 and _one(spark, burden.detection_limit(F.lit(0.06), F.lit(0.0), F.lit(0.07))) is None
