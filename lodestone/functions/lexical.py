"""Column builders over text: sentences, patterns, grades, guards."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Indexing terms that grade a record, strongest first.
GRADES = ["clinical", "in_vivo", "in_vitro", "ungraded"]
CLINICAL_TYPES = [
    "clinical trial", "randomized controlled trial", "controlled clinical trial", "clinical trial, phase i", "clinical trial, phase ii",
    "clinical trial, phase iii", "clinical trial, phase iv", "pragmatic clinical trial", "multicenter study", "observational study",
    "meta-analysis", "case reports", "clinical study",
]
CLINICAL_TERMS = [
    "clinical trials as topic", "randomized controlled trials as topic", "treatment outcome", "antineoplastic combined chemotherapy protocols",
    "maximum tolerated dose", "drug administration schedule",
]
IN_VIVO_TERMS = [
    "animals", "mice", "rats", "disease models, animal", "xenograft model antitumor assays", "heterografts", "zebrafish",
    "drosophila melanogaster", "caenorhabditis elegans", "mice, nude", "mice, inbred c57bl", "mice, scid",
]
IN_VITRO_TERMS = [
    "cell line", "cell line, tumor", "cells, cultured", "in vitro techniques", "hela cells", "hek293 cells", "mcf-7 cells", "fibroblasts",
    "saccharomyces cerevisiae", "schizosaccharomyces pombe", "cell culture techniques", "tumor cells, cultured",
    "saccharomyces cerevisiae proteins", "primary cell culture",
]
GRADE_WEIGHT = {"clinical": 1.0, "in_vivo": 0.7, "in_vitro": 0.45, "ungraded": 0.2}
# What text for the outside must not hold.
PRIVATE = [
    ("term_id", r"(?i)\bHP:\d{7}\b"),
    ("disease_id", r"(?i)\bOMIM:?\d{6}\b"),
    ("allele_change", r"\b[ACGT]{1,}>[ACGT]{1,}\b"),
    ("snp_id", r"(?i)\brs\d{3,}\b"),
    ("coordinate", r"(?i)\b(?:chr)?(?:[1-9]|1[0-9]|2[0-2]|X|Y|MT)[:-]\d{3,}\b"),
    ("hgvs", r"\b(?:c|p|g|m|n)\.[0-9A-Za-z_*+>-]{3,}\b"),
]
REPORT = [
    ("karyotype", r"\bkaryotype\s*[:=]\s*\d"),
    ("karyotype_string", r"\b4[5-9],\s*(?:XX|XY)\b"),
    ("disease_ontology_id", r"\bMONDO:\d+\b"),
]
# Fixed value: the form of a publication's identifier.
DOI = r"\b10\.\d{4,9}/[^\s\"')\]]+"
# Phrases that give a record its direction.
SUPPORT = [
    ("selectivity", r"selectiv"),
    ("sensitivity", r"\bsensitiv"),
    ("vulnerability", r"vulnerab"),
    ("synthetic_lethality", r"synthetic\s+lethal"),
    ("preferential_effect", r"preferential"),
    ("dependency", r"\bdepend(?:ence|ency|ent)\b"),
    ("antiproliferative", r"antiprolifer"),
    ("growth_inhibition", r"(?:growth|proliferation|viability)\s+\w*\s*(?:inhibit|suppress|arrest|reduc|impair)"),
]
ADVERSE = [
    ("aneugenic", r"aneugen"),
    ("genotoxic", r"genotoxic|clastogen"),
    ("induces_aneuploidy", r"induc\w*\s+(?:\w+\s+){0,3}(?:aneuploid|micronucle|chromosom\w+\s+(?:aberration|damage|loss))"),
    ("micronucleus_assay", r"micronucle(?:us|i)\s+(?:assay|test)"),
    ("chromosome_damage", r"chromosom\w+\s+(?:aberration|breakage|damage)"),
]
# Statements of label sections, and spans that negate them.
GENOTOXIC = [
    ("carcinogenic_finding", r"\b(?:was|were|is|are)\s+carcinogenic\b"),
    ("increased_tumours", r"\bincreas\w+\s+(?:the\s+)?(?:incidence|number)\s+of\s+(?:\w+\s+){0,3}(?:tumou?rs?|neoplasms?|carcinomas?|adenomas?|lymphomas?|leukemias?)"),
    ("mutagenic_finding", r"\b(?:was|were|is|are)\s+mutagenic\b|\bmutagenic\s+in\b"),
    ("clastogenic_finding", r"\bclastogenic\b"),
    ("aneugenic_finding", r"\baneugen\w+"),
    ("positive_genotoxicity_assay", r"\bpositive\b(?:\s+\w+){0,4}\s+(?:in\s+the\s+)?(?:ames|bacterial reverse mutation|micronucleus|chromosom\w+ aberration|mouse lymphoma)"),
    ("genotoxic_statement", r"\b(?:is|was|are|were)\s+genotoxic\b"),
    ("malignancy_risk", r"\bincreased risk of (?:\w+\s+){0,3}(?:malignanc|lymphoma|cancer|secondary (?:malignanc|cancer))"),
    ("secondary_malignancy", r"\bsecondary\s+(?:malignanc\w+|leukemia)\b"),
]
NEGATIVE = [
    r"\b(?:was|were|is|are)\s+not\s+(?:carcinogenic|mutagenic|genotoxic|clastogenic)\b",
    r"\bno\s+evidence\s+of\s+(?:carcinogenic|mutagenic|genotox|clastogenic)\w*",
    r"\bnegative\b(?:\s+\w+){0,4}\s+(?:in\s+the\s+)?(?:ames|bacterial reverse mutation|micronucleus|chromosom\w+ aberration|mouse lymphoma)",
    r"\bnot\s+(?:been\s+)?shown\s+to\s+be\s+(?:carcinogenic|mutagenic|genotoxic)\b",
]
_TERMS = r"(?:carcinogenic\w*|mutagenic\w*|clastogenic\w*|genotoxic\w*|aneugen\w+|tumou?rigenic\w*)"
NEGATED = [
    r"\b(?:not|neither|nor)\b[\w\s,-]{0,40}?\b" + _TERMS + r"(?:[\s,]+(?:or|and|nor)?[\s,]*" + _TERMS + r")*",
    r"\bno\s+(?:evidence|increase|significant\s+increase)\s+(?:of|in)\s+[\w\s,-]{0,40}?(?:" + _TERMS + r"|tumou?rs?|neoplasms?|micronucle\w+)",
    r"\bnegative\b[\w\s]{0,30}?\b(?:ames|bacterial\s+reverse\s+mutation|micronucleus|chromosom\w+\s+aberration|mouse\s+lymphoma)\b",
    r"\bnot\s+(?:been\s+)?shown\s+to\s+be\s+[\w\s]{0,20}?" + _TERMS,
    r"\bwithout\s+(?:evidence\s+of\s+)?[\w\s]{0,20}?" + _TERMS,
]
PEDIATRIC_DENIED = [
    ("safety_not_established", r"safety\s+and\s+(?:effectiveness|efficacy)[^.;]{0,90}?(?:have|has)\s+not\s+been\s+established"),
    ("not_established", r"\b(?:have|has)\s+not\s+been\s+established[^.;]{0,40}?\bpediatric\b"),
    ("not_indicated", r"\bnot\s+(?:indicated|recommended)\s+(?:for\s+use\s+)?in\s+(?:pediatric|children)"),
    ("contraindicated_in_children", r"\bcontraindicated\b(?:\s+\w+){0,6}\s+(?:pediatric|children)"),
]
PEDIATRIC_ESTABLISHED = [
    ("established", r"safety\s+and\s+(?:effectiveness|efficacy)\s+(?:of\s+\w+\s+)?(?:have|has)\s+been\s+established\s+in\s+pediatric"),
    ("indicated_in_children", r"\bindicated\b(?:\s+\w+){0,8}\s+pediatric\s+patients\b"),
    ("age_band", r"\bpediatric\s+patients\s+(?:aged\s+)?\d+\s+(?:years?|months?)\s+(?:of\s+age\s+)?(?:and\s+older|or\s+older|to\s+\d+)"),
]
# Classes of drugs that are taken as genotoxic.
CYTOTOXIC_CLASSES = [
    r"\balkylating\b", r"\bantimetabolite\b", r"\btopoisomerase inhibitor\b", r"\bnucleoside metabolic inhibitor\b", r"\banthracycline\b",
    r"\bplatinum-based drug\b", r"\bmicrotubule inhibitor\b", r"\bdna (?:methyltransferase|synthesis) inhibitor\b", r"\bradiopharmaceutical\b",
    r"\bproteasome inhibitor\b",
]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def normalise_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", " "))


def term_pattern(term: str) -> str:
    """A regular expression for a term: runs of white space match, ``*`` ends a word early."""
    parts = [r"\w*".join(re.escape(p) for p in w.split("*")) for w in term.split()]
    return "(?i)" + r"\s+".join(parts)


def sentences(text: Column) -> Column:
    """Pieces between end marks that white space follows; the look-behind is Java's."""
    return F.split(text, r"(?<=[.!?])\s+")


def cooccur(texts: Column, a: str, b: str) -> Column:
    """Whether one sentence of the array matches both patterns."""
    return F.exists(texts, lambda s: s.rlike(a) & s.rlike(b))


def matches(text: Column, patterns: list[tuple[str, str]]) -> Column:
    """Names of the patterns that the lower-cased text matches, in their order."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(name)) for name, p in patterns]))


def grade(types: Column, terms: Column) -> Column:
    low_types, low_terms = F.transform(types, F.lower), F.transform(terms, F.lower)
    return (
        F.when(F.arrays_overlap(low_types, _strings(CLINICAL_TYPES)) | F.arrays_overlap(low_terms, _strings(CLINICAL_TERMS)), "clinical")
        .when(F.arrays_overlap(low_terms, _strings(IN_VIVO_TERMS)), "in_vivo")
        .when(F.arrays_overlap(low_terms, _strings(IN_VITRO_TERMS)), "in_vitro")
        .otherwise("ungraded")
    )


def forbidden(text: Column, patterns: list[tuple[str, str]] = [*PRIVATE, *REPORT]) -> Column:
    """Names of the guards a text breaks; identifiers of publications are masked first."""
    masked = F.regexp_replace(text, DOI, " ")
    return F.array_compact(F.array(*[F.when(masked.rlike(p), F.lit(name)) for name, p in patterns]))


def unqualified(text: Column, word: str = "chemoprevention", qualifier: str = "secondary") -> Column:
    """Whether some sentence has the word without its qualifier."""
    return F.exists(sentences(text), lambda s: s.rlike(rf"(?i)\b{word}\b") & ~s.rlike(rf"(?i)\b{qualifier}\b"))


def html_escape(text: Column) -> Column:
    out = text
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def confidence(grade_: Column, supported: Column, contradicted: Column, n_adverse: Column, n_channels: Column, discriminating: Column) -> Column:
    """Strength in [0, 1] of a hypothesis: its grade's weight, scaled by what speaks against and for it."""
    base = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in GRADE_WEIGHT.items() for x in kv]), grade_), F.lit(GRADE_WEIGHT["ungraded"]))
    base = base * F.when(supported, 1.0).otherwise(0.4) * F.when(contradicted, 0.6).otherwise(1.0) * F.when(n_adverse > 0, 0.7).otherwise(1.0)
    base = F.least(F.lit(1.0), base * F.when(n_channels < 2, 1.0).when(discriminating, 1.25).otherwise(1.05))
    return F.round(F.greatest(F.lit(0.0), base), 3)


def valid_citations(given: Column, allowed: Column) -> Column:
    """Struct of the allowed and the dropped keys, each once, in the order given."""
    keys = F.array_distinct(F.transform(given, lambda k: F.lower(F.trim(k))))
    ok = F.transform(allowed, lambda k: F.lower(F.trim(k)))
    return F.struct(F.filter(keys, lambda k: F.array_contains(ok, k)).alias("kept"), F.filter(keys, lambda k: ~F.array_contains(ok, k)).alias("dropped"))


def as_list(value: Column) -> Column:
    """A list column that may come as text: NULL is empty, ``[..]`` is read, anything else is its one element."""
    text = F.trim(value)
    listed = F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(listed, F.array(value)))


def search_query(field: str, names: Column, context: list[str]) -> Column:
    """Names AND context for a literature search: phrases quoted, wildcards bare.

    A term with a wildcard and a space cannot be said and is an error, as is an
    empty context.
    """
    if not context:
        raise ValueError("without context a name alone would find all of its literature")

    def rendered(term: Column) -> Column:
        t = F.trim(term)
        wrong = F.raise_error(F.concat(F.lit("a wildcard stands in a phrase: "), t)).cast("string")
        bare = F.when(t.rlike(r"\s"), wrong).otherwise(F.concat(F.lit(f"{field}:"), t))
        return F.when(F.contains(t, F.lit("*")), bare).otherwise(F.concat(F.lit(f'{field}:"'), t, F.lit('"')))

    def clause(terms: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(terms, rendered), " OR "), F.lit(")"))

    return F.concat(clause(names), F.lit(" AND "), clause(_strings(context)))


def snippet(text: Column, pattern: str, limit: int = 600) -> Column:
    """The sentence round the first match, else the text's opening; white space collapsed, at most ``limit`` characters."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    hit = F.regexp_extract(flat, f"({pattern})", 1)
    at = F.instr(flat, hit)
    before, after = F.left(flat, at - 1), F.substring(flat, at + F.length(hit), F.length(flat))
    end = F.concat(F.substring_index(after, ".", 1), F.when(F.contains(after, F.lit(".")), ".").otherwise(""))
    sentence = F.trim(F.concat(F.substring_index(before, ".", -1), hit, end))
    return F.left(F.when((hit != "") & (sentence != ""), sentence).otherwise(flat), F.lit(limit))
