"""Ontologies as (term, parent) tables: closure, information content, similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import draw, without_replacement
from .order import numbered
from .tables import cut, discard


def closure(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, ancestor`` of every term, itself included; paths double each round."""
    own = terms.select("term", F.col("term").alias("ancestor"))
    known = cut(own.unionAll(edges.select("term", F.col("parent").alias("ancestor"))).distinct())
    n = known.count()
    while True:
        on = known.select(F.col("term").alias("ancestor"), F.col("ancestor").alias("far"))
        shorter, known = known, cut(known.join(on, "ancestor").select("term", F.col("far").alias("ancestor")).distinct())
        discard(shorter)
        more = known.count()
        if more == n:
            return known
        n = more


def associated(records: DataFrame, least: int) -> DataFrame:
    """Distinct ``entity, term`` that at least ``least`` of the records (entity, term) name."""
    return records.groupBy("entity", "term").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("entity", "term")


def information_content(annotations: DataFrame, closed: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n, ic``: -ln(max(n, 1) / N) over the entities that carry the term or one below."""
    total = annotations.agg(F.countDistinct("entity").alias("total"))
    up = annotations.join(closed, "term").groupBy(F.col("ancestor").alias("term")).agg(F.countDistinct("entity").alias("n"))
    counted = terms.select("term").join(up, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.join(F.broadcast(total)).select("term", "n", (-F.ln(F.greatest("n", F.lit(1)) / F.col("total"))).alias("ic"))


def similarities(queries: DataFrame, closed: DataFrame, ic: DataFrame) -> DataFrame:
    """``q, term, sim``: the information content of their most informative common ancestor."""
    a = queries.select(F.col("term").alias("q")).distinct().join(closed.withColumnRenamed("term", "q"), "q")
    with_ic = closed.join(ic.select(F.col("term").alias("ancestor"), "ic"), "ancestor")
    return a.join(with_ic, "ancestor").groupBy("q", "term").agg(F.max("ic").alias("sim"))


def best_match(queries: DataFrame, annotations: DataFrame, sims: DataFrame, by: list[str]) -> DataFrame:
    """Per entity the mean over query terms of its best term's similarity; absent is 0.

    ``queries`` has ``term`` and the columns ``by`` that tell queries apart.  Annotations
    are dealt out by entity once; what is made of them stays where it is.
    """
    n = queries.groupBy(*by).agg(F.count("*").alias("nq")) if by else queries.agg(F.count("*").alias("nq"))
    asked = sims.join(queries.select(F.col("term").alias("q")).distinct(), "q", "left_semi")
    best = annotations.repartition("entity").join(asked, "term").groupBy("entity", "q").agg(F.max("sim").alias("best"))
    summed = queries.withColumnRenamed("term", "q").join(best, "q").groupBy("entity", *by).agg(F.sum("best").alias("total"))
    joined = summed.join(n, by) if by else summed.join(F.broadcast(n))
    return joined.select("entity", *by, (F.col("total") / F.col("nq")).alias("score"))


def random_queries(pool: DataFrame, size: int, draws: int, seed: int) -> DataFrame:
    """``perm, term``: for each draw ``size`` terms of the pool without replacement, all of a smaller one."""
    placed = numbered(pool.select("term"), ["term"], name="nth")
    m = pool.count()
    perms = pool.sparkSession.range(draws).select(F.col("id").cast("int").alias("perm"))
    digits = F.array(*[draw(seed, F.col("perm"), F.lit(i)) % F.lit(m - i) for i in range(min(size, m))]).cast("array<bigint>")
    drawn = perms.select("perm", F.explode(without_replacement(digits)).alias("at"))
    return drawn.join(placed, F.col("at") == F.col("nth") - 1).select("perm", "term")


def permutation_p(observed: DataFrame, null: DataFrame, draws: int) -> DataFrame:
    """Adds ``p``: the share of draws that score at least as high, one added to both counts."""
    hits = observed.join(null.select("entity", F.col("score").alias("drawn")), "entity").filter(F.col("drawn") >= F.col("score") - 1e-12)
    counts = hits.groupBy("entity").agg(F.count("*").alias("k"))
    return observed.join(counts, "entity", "left").select("entity", "score", ((F.coalesce("k", F.lit(0)) + 1) / (draws + 1)).alias("p"))


def routes(hits: DataFrame, annotations: DataFrame, ic: DataFrame, of_hits: DataFrame, of_terms: DataFrame) -> DataFrame:
    """``target, s, support``: the best score or content that reaches a target, and the distinct hits and terms that do.

    ``of_hits`` and ``of_terms`` are links (entity, target).  An entity's terms are one row and travel as
    numbers, so a link is a row however many terms its entity has; they are told apart where the target's rows are.
    """
    numbers = cut(numbered(annotations.select("term").distinct(), ["term"], name="code")).select("term", F.col("code").cast("int").alias("code"))
    held = annotations.join(ic.select("term", "ic"), "term").join(numbers, "term")
    carried = held.repartition("entity").groupBy("entity").agg(F.max("ic").alias("s"), F.collect_set("code").alias("codes"))
    a = of_hits.join(hits, "entity").select("target", F.col("score").alias("s"), "entity").repartition("target")
    a = a.groupBy("target").agg(F.max("s").alias("s"), F.countDistinct("entity").alias("n"))
    b = of_terms.join(carried, "entity").select("target", "s", "codes").repartition("target").select("target", "s", F.explode("codes").alias("code"))
    b = b.groupBy("target").agg(F.max("s").alias("s"), F.countDistinct("code").alias("n"))
    return a.unionByName(b).groupBy("target").agg(F.max("s").alias("s"), F.sum("n").alias("support"))


def term_ratios(query: DataFrame, terms: DataFrame, closed: DataFrame, ic: DataFrame) -> DataFrame:
    """Per term the best share of a lineage-related query term's content: ``term, ratio``."""
    lineage = closed.select(F.col("term").alias("t"), F.col("ancestor").alias("q")).unionAll(closed.select("ancestor", "term")).distinct()
    related = terms.select(F.col("term").alias("t")).join(lineage, "t").join(query.select(F.col("term").alias("q")), "q")
    sims = similarities(query, closed, ic).select("q", F.col("term").alias("t"), "sim")
    own = ic.select(F.col("term").alias("q"), F.col("ic").alias("icq"))
    share = F.try_divide(F.col("sim"), F.nullif("icq", F.lit(0.0)))
    return related.join(sims, ["q", "t"]).join(own, "q").groupBy(F.col("t").alias("term")).agg(F.max(share).alias("ratio"))


def subtree(closed: DataFrame, root: str) -> DataFrame:
    """Terms under a root, itself included, by their closure (term, ancestor)."""
    return closed.filter(F.col("ancestor") == root).select("term").distinct()
