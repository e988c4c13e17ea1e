"""The one-pass pattern scanner against plain searches over the whole text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.functions import lexical, scan

TABLES = {n: getattr(lexical, n) for n in ("SUPPORT", "ADVERSE", "GENOTOXIC", "PEDIATRIC_DENIED", "PEDIATRIC_ESTABLISHED", "PRIVATE", "REPORT")}
PATTERNS = [p for t in TABLES.values() for _, p in t] + lexical.NEGATED + lexical.NEGATIVE + lexical.CYTOTOXIC_CLASSES + [lexical.DOI, r"a|b", r"x?", r".*", r"[^;]{2}q+", r"(?:ab|c)d[\w.]*end", r"\d{4,}", "straße"]
PARTS = [
    "was", "not", "Carcinogenic", "MUTAGENIC", "clastogenic", "aneugenic", "genotoxic", "no evidence of", "increased", "the", "incidence", "of", "tumors", "tumours", "negative", "positive", "in the", "Ames", "micronucleus", "assay",
    "induces", "chromosomal", "aberration", "safety and effectiveness", "have", "not been established", "in pediatric", "patients", "indicated", "aged 12 years and older", "without", "shown to be", "nor", "secondary", "leukemia",
    "increased risk of", "lymphoma", "sensitivity", "dependence", "growth", "inhibited", "ſecondary leuKemia", "İ", "ı", "ß", "\n", "  ", ".", ",", ";", ". ", "-", "(", ")", ":", "rs12345", "HP:0000001", "10.1158/x.y", "abd.end", "qq", "12345", "\xa0", "é",
]


def _text(rng):
    return "".join(rng.choice(PARTS) + rng.choice([" ", " ", " ", "", "\n"]) for _ in range(rng.randrange(0, 60)))


@pytest.mark.parametrize("seed", range(4))
def test_spans_are_those_of_the_whole_text(seed):
    rng = random.Random(seed)
    scanner = scan.Scanner(PATTERNS)
    whole = [re.compile(p, re.IGNORECASE) for p in PATTERNS]
    for _ in range(400):
        text = _text(rng)
        assert len(scan.folded(text)) == len(text)
        seen = scanner.look(text)
        for i, p in enumerate(whole):
            want = [m.span() for m in p.finditer(text)]
            if rng.random() < 0.5:
                assert seen.matches(i) == bool(want), (PATTERNS[i], text)
            assert seen.spans(i) == want, (PATTERNS[i], text)


def test_first_free_against_brute_force():
    rng = random.Random(9)
    names = lexical.GENOTOXIC
    scanner = scan.Scanner([p for _, p in names] + lexical.NEGATED)
    masks = list(range(len(names), len(names) + len(lexical.NEGATED)))
    for _ in range(1500):
        text = _text(rng)
        covered = [m.span() for p in lexical.NEGATED for m in re.finditer(p, text, re.I)]
        want = next((n for n, p in names if any(not any(a <= m.start() < b for a, b in covered) for m in re.finditer(p, text, re.I))), None)
        assert scanner.look(text).first_free([(n, i) for i, (n, _) in enumerate(names)], masks) == want


def test_one_sentence_against_brute_force():
    rng = random.Random(4)
    a, b = "sensitiv", r"tumou?rs?\.?\s?the"
    scanner = scan.Scanner([a, b])
    for _ in range(3000):
        text = "".join(rng.choice(["Sensitive", "tumor", "tumor. the", "tumor the", "x", ".", "! ", ". ", "?\n", " ", " "]) for _ in range(rng.randrange(12)))
        want = any(re.search(a, s, re.I) and re.search(b, s, re.I) for s in re.split(r"(?<=[.!?])\s+", text))
        assert scanner.look(text).together(0, 1) == want, text


def test_long_texts_cost_their_length():
    text = "carcinogenic word " * 60_000
    seen = scan.Scanner([p for _, p in lexical.GENOTOXIC]).look(text)
    assert not seen.matches(0) and not seen.matches(1)


def test_names_of_a_column(spark):
    rows = [(1, "A selective agent. It was licensed; under law"), (2, None), (3, ""), (4, "clastogenic, SENSITIVE"), (5, "Licensed. Under"), (6, "under licensed")]
    df = spark.createDataFrame(rows, "k int, text string")
    x = scan.names_of(F.col("text"), {"support": lexical.SUPPORT, "adverse": lexical.ADVERSE}, {"both": (lexical.term_pattern("licensed"), lexical.term_pattern("under"))})
    got = {r.k: (r.support, r.adverse, r.both) for r in df.select("k", x.alias("x")).select("k", "x.*").collect()}
    assert got == {1: (["selectivity"], [], True), 2: ([], [], False), 3: ([], [], False), 4: (["sensitivity"], ["genotoxic"], False), 5: ([], [], False), 6: ([], [], True)}
    assert df.limit(0).select(x).count() == 0


def test_names_come_from_arrow_and_not_from_pandas(spark):
    x = scan.names_of(F.lit("selective"), {"support": lexical.SUPPORT}).alias("x")
    plan = spark.range(2).select(x).select("x.*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "], 251" in plan  # PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF


def test_a_filter_on_verdicts_does_not_read_the_texts_again(spark):
    from lodestone.operators import triage

    labels = spark.range(4).selectExpr("id", "map('nonclinical_toxicology', concat('It was genotoxic ', id)) AS sections", "array('Prescription') AS statuses", "array('x') AS classes")
    exploded = triage.verdicts(labels).select("id", F.explode("verdicts").alias("v")).filter("v.verdict = 'excluded'")
    plan = exploded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "], 251" in plan
    assert {r.v.reason for r in exploded.collect()} == {"genotoxic_statement", "insufficient_evidence"}
