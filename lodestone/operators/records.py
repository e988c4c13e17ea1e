"""Drug, evidence and signature records: joins that keep what they cannot match, and say why rows go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import draw
from .order import numbered

APPROVED = "APPROVAL"


def attach(configs: DataFrame, evidence: DataFrame) -> DataFrame:
    """``id, evidence`` for (id, members): each member's value or NULL, in the members' order.

    ``evidence`` has one row a key (key, value).
    """
    long = configs.select("id", F.posexplode_outer("members").alias("pos", "key"))
    joined = long.join(evidence, "key", "left")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"])
    return joined.groupBy("id").agg(listed.alias("evidence"))


def same_residue(alleles: DataFrame, archive: DataFrame) -> DataFrame:
    """Per allele the first archive record at its residue of its transcript with another change.

    Both have transcript, residue and change; alleles id, the archive rec.
    """
    other = archive.select("transcript", "residue", F.col("change").alias("other"), "rec")
    met = alleles.join(other, ["transcript", "residue"]).filter(F.col("change") != F.col("other"))
    return met.groupBy("id").agg(F.min("rec").alias("rec"))


def observed(ac: Column) -> Column:
    """Whether a count says that an allele was seen: neither NULL nor 0."""
    return F.coalesce(ac, F.lit(0)) > 0


def excluded_contigs(contig: Column, sex: Column) -> Column:
    """Why a contig takes no part: Y never does, X only where two copies are expected; else NULL."""
    return F.when(contig == "Y", "hemizygous_mismapping").when(
        (contig == "X") & (sex != "XX"), F.concat(F.lit("not_diploid_under_inferred_sex_"), sex)
    )


def of_contigs(sites: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """Sites of the named contigs, and the names that no site has; none at all is an error."""
    kept = sites.filter(F.col("contig").isin(names))
    found = {r["contig"] for r in kept.select("contig").distinct().collect()}  # at most the names
    if not found:
        raise ValueError(f"no site lies on any of {names}")
    return kept, [n for n in names if n not in found]


def induced(sym: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among ``nodes``."""
    inside = nodes.select("node").distinct()
    out = sym.join(inside.withColumnRenamed("node", "src"), "src", "left_semi")
    return out.join(inside.withColumnRenamed("node", "dst"), "dst", "left_semi").select(*sym.columns)


def targets(mechanisms: DataFrame, proteins: DataFrame) -> DataFrame:
    """``drug, targets, unmapped`` of (drugs, targets) rows of lists: proteins found, and genes that have none.

    A drug that loses all its genes keeps an empty set: that is how a broken
    crosswalk looks.  ``proteins`` has one row a gene (gene, protein).
    """
    pairs = mechanisms.select(F.explode("drugs").alias("drug"), "targets").distinct().select("drug", F.explode_outer("targets").alias("gene")).distinct()
    joined = pairs.join(proteins, "gene", "left")
    lost = F.when(F.col("protein").isNull(), F.col("gene"))
    return joined.groupBy("drug").agg(F.array_sort(F.collect_set("protein")).alias("targets"), F.array_sort(F.collect_set(lost)).alias("unmapped"))


def drug_records(drugs: DataFrame, molecules: DataFrame, indications: DataFrame, approved_only: bool = True) -> DataFrame:
    """``drug, name, stage, approved, n_indications``: identities may be missing and are blank then.

    Indications count once, and only those whose own stage is the approval, if asked for.
    """
    named = drugs.join(molecules, "drug", "left")
    rows = indications.filter(F.col("stage") == APPROVED) if approved_only else indications
    per = rows.select("drug", "indication").distinct().groupBy("drug").agg(F.count("*").alias("n_indications"))
    stage = F.coalesce("stage", F.lit(""))
    return named.join(per, "drug", "left").select(
        "drug", F.coalesce("name", F.lit("")).alias("name"), stage.alias("stage"), (stage == APPROVED).alias("approved"), F.coalesce("n_indications", F.lit(0)).cast("bigint").alias("n_indications")
    )


def judged_signatures(meta: DataFrame, names: DataFrame, molecules: DataFrame, rows: DataFrame) -> DataFrame:
    """``meta`` (sig, kind, name) with key, place in the matrix and the reason it is left out, NULL if it is not.

    Reasons are tried in order: no compound, name unresolved, not approved, not in the matrix.
    """
    j = meta.join(names, "name", "left").join(molecules.select("key", "stage"), "key", "left").join(rows.select("sig", "place"), "sig", "left")
    why = (
        F.when(F.trim("kind") != "compound", "no_compound")
        .when(F.col("key").isNull(), "name_unresolved")
        .when(F.coalesce("stage", F.lit("")) != APPROVED, "not_approved")
        .when(F.col("place").isNull(), "not_in_matrix")
    )
    return j.withColumn("reason", why)


def gene_axis(first: DataFrame, second: DataFrame, landmarks: DataFrame, least: float = 0.9) -> DataFrame:
    """``gene, i``: genes (gene, place) of both releases among the landmarks, in the first one's order.

    Too few of the landmarks are an error: the releases are of different platforms.
    The axis is as long as the list of genes, so one ordered pass is enough.
    """
    shared = first.join(second.select("gene"), "gene", "left_semi").join(landmarks.select("gene"), "gene", "left_semi")
    n, wanted = shared.count(), landmarks.count()
    if n < least * wanted:
        raise ValueError(f"only {n} of {wanted} landmark genes are in both releases")
    return shared.select("gene", (F.row_number().over(Window.orderBy("place")) - 1).cast("bigint").alias("i"))


def classified(records: DataFrame) -> DataFrame:
    """Adds ``bucket`` to records (origin, citable, withdrawn, adverse, support, cooccurs): the first that holds."""
    curated = F.col("origin") == "curated"
    bucket = (
        F.when(~F.col("citable"), "uncitable")
        .when(F.col("withdrawn"), "withdrawn")
        .when(F.size("adverse") > 0, "adverse_direction")
        .when(curated, "supporting_curated")
        .when(~F.col("cooccurs"), "no_cooccurrence")
        .when(F.size("support") == 0, "no_direction")
        .otherwise("supporting_retrieved")
    )
    return records.withColumn("bucket", bucket)


def bucket_counts(records: DataFrame, by: str) -> DataFrame:
    """Counters over all records examined, kept or not, and those of the supporting ones."""

    def of(*names):
        return F.count_if(F.col("bucket").isin(*names))

    return records.groupBy(by).agg(
        F.count("*").alias("n_examined"), F.count_if(F.col("origin") == "curated").alias("n_curated"), F.count_if(F.col("origin") == "retrieved").alias("n_retrieved"),
        of("uncitable").alias("n_uncitable"), of("withdrawn").alias("n_withdrawn"), of("adverse_direction").alias("n_adverse_direction"), of("no_cooccurrence").alias("n_no_cooccurrence"),
        of("no_direction").alias("n_no_direction"), of("supporting_curated", "supporting_retrieved").alias("n_supporting"), of("supporting_curated").alias("n_supporting_curated"),
    )


def merged_texts(sections: DataFrame) -> DataFrame:
    """``key, text`` of (key, ord, text): texts joined in order, without those that what stands already holds.

    A text that comes again adds nothing, so each counts at its first place and a
    key gathers no more than its distinct texts.
    """
    once = sections.filter("text IS NOT NULL AND text <> ''").groupBy("key", "text").agg(F.min("ord").alias("ord"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"])
    joined = F.aggregate(listed, F.lit(""), lambda held, t: F.when(F.contains(held, t), held).otherwise(F.trim(F.concat_ws(" ", held, t))))
    return once.groupBy("key").agg(joined.alias("text"))


def fingerprint(names: DataFrame) -> DataFrame:
    """One row: how many distinct lower-cased names there are and the SHA-256 of them, sorted, a line each.

    For a curated list: it is gathered in one place.
    """
    n = names.select(F.lower(F.trim("name")).alias("name")).filter("name <> ''").distinct()
    return n.agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("name")), "\n"), 256).alias("fingerprint"))


def narrowed(rows: DataFrame, survivors: DataFrame, key: str, order: list, top: int) -> DataFrame:
    """Rows of the survivors; without any survivor the first ``top`` rows in order."""
    return rows.orderBy(*order).limit(top) if survivors.isEmpty() else rows.join(survivors.select(key).distinct(), key, "left_semi")


def complete(rows: DataFrame, survivors: DataFrame, key: str) -> DataFrame:
    """``survivors`` joined with their ``rows``; one without a row is an error."""
    missing = F.raise_error(F.concat(F.lit("nothing is recorded for "), F.col(key).cast("string"))).cast("boolean")
    out = survivors.join(rows.withColumn("__here", F.lit(True)), key, "left")
    return out.filter(F.coalesce("__here", missing)).drop("__here")


def capped(rows: DataFrame, by: list[str], order: list, most: int, parts: int = 32) -> DataFrame:
    """The first ``most`` rows of each group in order; ties that the order leaves are cut anyhow.

    Rows are ranked in ``parts`` parts of a group first (Spark keeps the best of a part before it
    shuffles), so a hot group is many tasks' work and its last task sees ``parts * most`` rows.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    part = Window.partitionBy(*by, "__part").orderBy(*keys)
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(parts)))
    best = dealt.withColumn("__n", F.row_number().over(part)).filter(F.col("__n") <= most).drop("__n", "__part")
    whole = Window.partitionBy(*by).orderBy(*keys) if by else Window.orderBy(*keys)
    return best.withColumn("__n", F.row_number().over(whole)).filter(F.col("__n") <= most).drop("__n")


def unmapped(rows: DataFrame, value: str, mapped: Column) -> DataFrame:
    """``value, n``: how often each value comes that a vocabulary does not map."""
    return rows.filter(F.col(value).isNotNull() & mapped.isNull()).groupBy(value).agg(F.count("*").alias("n"))


def control_queries(queries: DataFrame, observed_query: str, wanted: int, seed: int) -> DataFrame:
    """``wanted`` queries other than the observed one, by a hash of their names; too few are an error."""
    others = queries.select("query").distinct().filter(F.col("query").cast("string") != observed_query)
    n = others.count()
    if n < wanted:
        raise ValueError(f"only {n} queries are left for {wanted} controls")
    return others.orderBy(draw(seed, F.col("query")), "query").limit(wanted)


def deepest(rungs: DataFrame) -> DataFrame:
    """One row: the deepest rung that passes, 0 if none does; a failing rung above does not end the ladder."""
    return rungs.agg(F.coalesce(F.max(F.when(F.col("passes"), F.col("depth"))), F.lit(0)).cast("bigint").alias("depth"))


def nominated(scores: DataFrame, depth: DataFrame) -> DataFrame:
    """``key, score, rank, percentile``: the keys down to the depth; percentiles are of all keys."""
    total = scores.agg(F.count("*").alias("total"))
    ranked = numbered(scores, ["score", "key"], name="rank").join(F.broadcast(total)).withColumn("percentile", 100 * F.col("rank") / F.col("total"))
    return ranked.join(F.broadcast(depth)).filter("rank <= depth").select("key", "score", "rank", "percentile")
