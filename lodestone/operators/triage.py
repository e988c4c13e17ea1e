"""Exclusion gates that fail closed, each with an auditable reason."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from ..functions import lexical
from ..functions.scan import Scanner

# Sections and statuses.
WARNINGS = ["boxed_warning", "warnings_and_cautions", "warnings"]
FINDINGS = ["carcinogenesis_and_mutagenesis_and_impairment_of_fertility", "nonclinical_toxicology"]
MARKETED = ["Prescription", "Over-the-counter"]


def _verdict(rule: str, verdict: Column, reason: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), verdict.alias("verdict"), reason.alias("reason"))


def _section(name: str) -> Column:
    return F.nullif(F.trim(F.coalesce(F.try_element_at("sections", F.lit(name)), F.lit(""))), F.lit(""))


RISK = [p for p in lexical.GENOTOXIC if p[0] in ("malignancy_risk", "secondary_malignancy")]
_HITS = [*WARNINGS, "geno", "ok", "no", "negative"]
_HIT = pa.struct([(n, pa.bool_() if n == "negative" else pa.string()) for n in _HITS])


def _numbered(*tables: list) -> tuple[list[str], list[list[int]]]:
    """All patterns of the tables, and the numbers of each table's own."""
    patterns = [p for table in tables for p in table]
    ends = [sum(map(len, tables[: k + 1])) for k in range(len(tables))]
    return patterns, [list(range(end - len(table), end)) for table, end in zip(tables, ends)]


def _hits(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """What the sections say: each text is passed once, and only what its needles point at is looked at."""
    risk, geno, established, denied = ([p for _, p in t] for t in (RISK, lexical.GENOTOXIC, lexical.PEDIATRIC_ESTABLISHED, lexical.PEDIATRIC_DENIED))
    of_risk, (r, r_mask) = _numbered(risk, lexical.NEGATED)
    of_geno, (g, g_mask, negative) = _numbered(geno, lexical.NEGATED, lexical.NEGATIVE)
    of_child, (e, d, d_mask) = _numbered(established, denied, lexical.NEGATED)
    risks, genos, children = Scanner(of_risk), Scanner(of_geno), Scanner(of_child)
    named = {
        "risk": [(n, i) for (n, _), i in zip(RISK, r)], "geno": [(n, i) for (n, _), i in zip(lexical.GENOTOXIC, g)],
        "ok": [(n, i) for (n, _), i in zip(lexical.PEDIATRIC_ESTABLISHED, e)], "no": [(n, i) for (n, _), i in zip(lexical.PEDIATRIC_DENIED, d)],
    }
    for warnings_finding_child in batches:
        rows = []
        for texts in zip(*warnings_finding_child):  # of a batch only one row at a time is strings of Python's
            *warned, finding, child = (t.as_py() for t in texts)
            row = [risks.look(t).first_free(named["risk"], r_mask) if t else None for t in warned]
            seen = genos.look(finding or "")
            of = children.look(child or "")
            row += [seen.first_free(named["geno"], g_mask), of.first_free(named["ok"], d), of.first_free(named["no"], d_mask), any(seen.matches(i) for i in negative)]
            rows.append(dict(zip(_HITS, row)))
        yield pa.array(rows, _HIT)


@dataclass(frozen=True)
class Rule:
    """A rule: its name, whether it excludes, and what gives (verdict, reason) from the columns of ``read``."""

    name: str
    hard: bool
    judge: Callable[[], tuple[Column, Column]]


EXCLUDED, PASSED = "excluded", "pass"


def _genotoxic() -> tuple[Column, Column]:
    classes = F.coalesce(F.array_join("classes", " "), F.lit(""))
    warned = F.coalesce(*[F.col(f"__hit.{n}") for n in WARNINGS])
    reason = (
        F.when(classes.rlike("(?i)" + "|".join(lexical.CYTOTOXIC_CLASSES)), "cytotoxic_class")
        .when(warned.isNotNull(), warned)
        .when(F.col("__hit.geno").isNotNull(), F.col("__hit.geno"))
        .when(F.col("__hit.negative"), "negative_findings_reported")
        .otherwise("insufficient_evidence")
    )
    return F.when(reason == "negative_findings_reported", PASSED).otherwise(EXCLUDED), reason


def _pediatric() -> tuple[Column, Column]:
    return F.when(F.col("__hit.ok").isNotNull(), PASSED).otherwise(EXCLUDED), F.coalesce("__hit.ok", "__hit.no", F.lit("insufficient_evidence"))


def _marketed() -> tuple[Column, Column]:
    known = F.size(F.coalesce("statuses", F.array().cast("array<string>"))) > 0
    sold = F.coalesce(F.arrays_overlap("statuses", F.array(*[F.lit(s) for s in MARKETED])), F.lit(False))
    reason = F.when(~known, "insufficient_evidence").when(sold, "marketed").otherwise("not_currently_marketed")
    return F.when(reason == "marketed", PASSED).otherwise(EXCLUDED), reason


def _barrier() -> tuple[Column, Column]:
    return F.lit("not_applicable"), F.lit("endpoint_has_no_cns_requirement")


def _status() -> tuple[Column, Column]:
    warned = [_section(n).isNotNull() for n in ["contraindications", "warnings_and_cautions", "warnings"]]
    reason = (
        F.when(F.col("sections").isNull(), "no_label")
        .when(F.col("__boxed_warning").isNotNull(), "boxed_warning_present")
        .when(warned[0] | warned[1] | warned[2], "warnings_recorded")
        .otherwise("no_warning_sections")
    )
    return F.when(F.col("sections").isNull(), "not_applicable").otherwise(PASSED), reason


#: The rules in their order (names are fixed values).  A caller's own list may follow, lack or replace some of them.
RULES = [
    Rule("genotoxic_or_cancer_risk", True, _genotoxic),
    Rule("pediatric_use", True, _pediatric),
    Rule("currently_marketed", True, _marketed),
    Rule("bbb_penetration", False, _barrier),
    Rule("clinical_status", False, _status),
]


def verdicts(labels: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Adds ``verdicts``, ``survives`` and ``excluded_by``: the first hard rule that excludes.

    ``labels`` has id, sections (map, NULL without a label), statuses (array,
    NULL without a record) and classes (array).  What cannot be read excludes.  A
    verdict that is NULL excludes too; two rules of one name are an error.
    """
    rules = RULES if rules is None else rules
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("two rules have one name")
    rows = labels.withColumns({f"__{n}": _section(n) for n in [*WARNINGS, "pediatric_use"]})
    rows = rows.withColumn("__finding", F.coalesce(*[_section(n) for n in FINDINGS]))
    hits = F.arrow_udf(_hits, from_arrow_type(_HIT)).asNondeterministic()  # so no filter on the verdicts runs it a second time
    rows = rows.withColumn("__hit", hits(*[F.col(f"__{n}") for n in [*WARNINGS, "finding", "pediatric_use"]]))
    judged = []
    for rule in rules:
        verdict, reason = rule.judge()
        judged.append(_verdict(rule.name, F.coalesce(verdict, F.lit(EXCLUDED)), F.coalesce(reason, F.lit("insufficient_evidence"))))
    rows = rows.withColumn("verdicts", F.array(*judged) if judged else F.array().cast("array<struct<rule:string,verdict:string,reason:string>>"))
    hard = F.filter("verdicts", lambda v: (v["verdict"] == EXCLUDED) & v["rule"].isin([r.name for r in rules if r.hard]))
    rows = rows.withColumn("survives", F.size(hard) == 0).withColumn("excluded_by", F.get(hard, F.lit(0))["rule"])
    return rows.select(*labels.columns, "verdicts", "survives", "excluded_by")


def verdict_counts(judged: DataFrame) -> DataFrame:
    """Counts by rule and verdict, by rule and reason: one pass with grouping sets."""
    long = judged.select(F.explode("verdicts").alias("v")).select("v.*")
    return (
        long.groupingSets([["rule", "verdict"], ["rule", "reason"]], "rule", "verdict", "reason")
        .agg(F.count("*").alias("n"))
        .select("rule", "verdict", "reason", "n")
    )
