"""Column builders for alleles, their annotations and archive classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vocabularies of the annotation and archive formats.
LOF_EFFECTS = ["stop_gained", "frameshift_variant", "splice_acceptor_variant", "splice_donor_variant", "exon_loss_variant", "transcript_ablation"]
IMPACTS = ["HIGH", "MODERATE", "LOW", "MODIFIER"]
REVIEW_STARS = {
    "practice_guideline": 4,
    "reviewed_by_expert_panel": 3,
    "criteria_provided,_multiple_submitters,_no_conflicts": 2,
    "criteria_provided,_multiple_submitters": 2,
    "criteria_provided,_single_submitter": 1,
    "criteria_provided,_conflicting_classifications": 1,
    "criteria_provided,_conflicting_interpretations": 1,
    "no_assertion_criteria_provided": 0,
    "no_assertion_provided": 0,
    "no_classification_provided": 0,
    "no_interpretation_for_the_single_variant": 0,
    "no_classification_for_the_single_variant": 0,
    "no_classifications_from_unflagged_records": 0,
}
SIGNIFICANCE = [
    ("conflicting", ["Conflicting_classifications_of_pathogenicity", "Conflicting_interpretations_of_pathogenicity"]),
    ("pathogenic", ["Pathogenic"]),
    ("likely_pathogenic", ["Likely_pathogenic"]),
    ("benign", ["Benign"]),
    ("likely_benign", ["Likely_benign"]),
    ("uncertain", ["Uncertain_significance", "Uncertain_risk_allele"]),
]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def minimal(pos: Column, ref: Column, alt: Column) -> Column:
    """(pos, ref, alt) in upper case without shared ends, a base kept on each side.

    The longest common suffix goes first, then the longest common prefix; both
    lengths are found at once rather than base by base.
    """
    a, b = F.upper(ref), F.upper(alt)

    def longest(x: Column, y: Column, suffix: bool) -> Column:
        most = F.least(F.length(x), F.length(y)) - 1

        def same(k):
            return F.right(x, k) == F.right(y, k) if suffix else F.left(x, k) == F.left(y, k)

        return F.array_max(F.filter(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), lambda k: same(k) | (k == 0)))

    def once(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]  # a lambda's value is computed once

    def cut_prefix(x):
        p = longest(x["a"], x["b"], False)
        return once(p, lambda k: F.struct((pos + k).cast("bigint").alias("pos"), F.substr(x["a"], k + 1, F.length(x["a"])).alias("ref"), F.substr(x["b"], k + 1, F.length(x["b"])).alias("alt")))

    def cut_suffix(t):
        return once(F.struct(F.left(a, F.length(a) - t).alias("a"), F.left(b, F.length(b) - t).alias("b")), cut_prefix)

    # most alleles are one base long, and have nothing to share
    whole = F.struct(pos.cast("bigint").alias("pos"), a.alias("ref"), b.alias("alt"))
    return F.when(F.least(F.length(a), F.length(b)) <= 1, whole).otherwise(once(longest(a, b, True), cut_suffix))


def with_minimal(rows: DataFrame, pos: str, ref: str, alt: str) -> DataFrame:
    """``rows`` with the struct ``m`` of ``minimal``: a generator, so it is computed once a row whatever reads its fields."""
    return rows.select("*", F.explode(F.array(minimal(F.col(pos), F.col(ref), F.col(alt)))).alias("m"))


def significance_class(clnsig: Column) -> Column:
    """The class of the leading statement, by precedence over its alternatives."""
    parts = F.transform(F.split(F.split(clnsig, r"\|")[0], "/"), lambda p: F.trim(F.replace(p, F.lit("_low_penetrance"), F.lit("")), F.lit("_")))
    out = None
    for name, terms in SIGNIFICANCE:
        hit = F.arrays_overlap(parts, _strings(terms))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def review_stars(status: Column) -> Column:
    """Stars of a review status; an unknown one is NULL and not 0."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in REVIEW_STARS.items() for x in kv]), status)


def effect_class(effects: Column, biotype: Column, impact: Column) -> Column:
    return (
        F.when(biotype != "protein_coding", "other")
        .when(F.arrays_overlap(effects, _strings(LOF_EFFECTS)), "lof")
        .when(impact.isin("HIGH", "MODERATE"), "protein_altering")
        .otherwise("other")
    )


def impact_rank(impact: Column) -> Column:
    """Larger is more severe; unknown is -1."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for i, k in enumerate(reversed(IMPACTS)) for x in (k, i)]), impact), F.lit(-1))


def lof_tier(primary: Column, secondary: Column) -> Column:
    """Tier from the two passes; a primary finding without a secondary one is an error."""
    wrong = F.raise_error(F.lit("loss of function on the selected transcript but on none of all")).cast("string")
    return F.when(primary & secondary, "mane_select").when(primary, wrong).when(secondary, "non_mane").otherwise("not_lof")


def zygosity(gt: Column) -> Column:
    return F.when(F.size(gt) == 1, "hemizygous").when(F.size(F.array_distinct(gt)) == 1, "hom_alt").otherwise("het")


def protein_position(hgvs_p: Column) -> Column:
    return F.regexp_extract(hgvs_p, r"^p\.[A-Za-z]{3}(\d+)", 1).try_cast("int")


def last_exon(rank: Column) -> Column:
    """Whether an ``n/m`` rank is the last; NULL where it is none."""
    n, m = F.split(rank, "/").getItem(0).try_cast("int"), F.get(F.split(rank, "/"), F.lit(1)).try_cast("int")
    return n == m


def bare_contig(contig: Column) -> Column:
    return F.regexp_replace(contig, "^chr", "")


def prefixed_contig(contig: Column) -> Column:
    """The name with one ``chr``, whichever way it came."""
    return F.concat(F.lit("chr"), bare_contig(contig))


def remote_contig(contig: Column, prefixed: bool) -> Column:
    """The name as another file spells it: with or without ``chr``."""
    return prefixed_contig(contig) if prefixed else bare_contig(contig)


def phase(partner: Column, pid_a: Column, pid_b: Column, pgt_a: Column, pgt_b: Column) -> Column:
    """trans, cis or unphased: a 1/2 partner first, then shared phase sets."""
    return (
        F.when(F.coalesce(partner, F.lit(False)), "trans")
        .when((pid_a == pid_b) & (pgt_a != pgt_b), "trans")
        .when((pid_a == pid_b) & (pgt_a == pgt_b), "cis")
        .otherwise("unphased")
    )


def info_map(info: Column) -> Column:
    """``k=v;k=v`` as a map: flags are dropped, values keep later ``=``, the last key wins."""
    pairs = F.filter(F.split(info, ";"), lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.substr(p, F.instr(p, F.lit("=")) + 1, F.length(p)).alias("value")))

    def last(all_):
        return F.filter(all_, lambda e, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda o: o["key"] == e["key"]))

    return F.map_from_entries(F.transform(F.array(entries), last)[0])  # a lambda's value is computed once


def info_value(info: Column, key: str) -> Column:
    """The value of one key in ``info_map``, without the map; NULL where it is missing."""
    last = F.try_element_at(F.filter(F.split(info, ";"), lambda p: F.startswith(p, F.lit(f"{key}="))), F.lit(-1))
    return F.substring(last, len(key) + 2, 1 << 30)


def annotations(ann: Column) -> Column:
    """Structs of an ANN field: pipe-separated, effects split at ``&``; short ones dropped."""
    rows = F.filter(F.transform(F.split(ann, ","), lambda a: F.split(a, r"\|")), lambda p: F.size(p) >= 11)
    return F.transform(
        rows,
        lambda p: F.struct(
            p[0].alias("allele"), F.split(p[1], "&").alias("effects"), p[2].alias("impact"), p[3].alias("gene"), p[5].alias("feature_type"),
            p[6].alias("transcript"), p[7].alias("biotype"), p[8].alias("rank"), p[9].alias("hgvs_c"), p[10].alias("hgvs_p"),
        ),
    )
