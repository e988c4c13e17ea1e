"""Rank aggregation over channels, convergence classes and the blinded benchmark."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import draw
from .order import numbered
from .tables import cut

BROAD_FRACTION = 0.5
#: Draws of a bootstrap that one task makes.
DRAWS = 1 << 20


def normalised_ranks(rankings: DataFrame) -> DataFrame:
    """``channel, key, r``: the best position over the channel's own list length.

    ``rankings`` has channel, key, position.  A key that a channel lists twice
    keeps its best position; the length counts every row.
    """
    totals = rankings.groupBy("channel").agg(F.count("*").alias("total"))
    best = rankings.groupBy("channel", "key").agg(F.min("position").alias("position"))
    return best.join(F.broadcast(totals), "channel").select("channel", "key", (F.col("position") / F.col("total")).alias("r"))  # a row a channel


def beta_tail(r: Column, i: int, n: int) -> Column:
    """P(at least i of n uniform draws are <= r): the CDF of the i-th order statistic."""
    terms = [F.lit(float(math.comb(n, j))) * F.pow(r, F.lit(j)) * F.pow(1 - r, F.lit(n - j)) for j in range(i, n + 1)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.when(r >= 1, 1.0).when(r <= 0, 0.0).otherwise(total)


def robust_rank_aggregation(ranks: DataFrame, channels: int) -> DataFrame:
    """``key, p, score, n_support``: the least order-statistic p, times the channels, at most 1."""
    w = Window.partitionBy("key").orderBy("r", "channel")
    ordered = ranks.withColumn("i", F.row_number().over(w))
    p = None
    for i in range(1, channels + 1):
        here = F.col("i") == i
        p = F.when(here, beta_tail(F.col("r"), i, channels)) if p is None else p.when(here, beta_tail(F.col("r"), i, channels))
    return (
        ordered.withColumn("p", p)
        .groupBy("key")
        .agg(F.min("p").alias("p"), F.count("*").alias("n_support"))
        .withColumn("score", F.least(F.lit(1.0), F.col("p") * channels))
    )


def broad_channels(ranks: DataFrame, fraction: float = BROAD_FRACTION) -> DataFrame:
    """``channel, broad``: whether it ranks more than a fraction of all keys."""
    pool = ranks.agg(F.countDistinct("key").alias("pool"))
    per = ranks.groupBy("channel").agg(F.countDistinct("key").alias("n"))
    return per.join(F.broadcast(pool)).select("channel", (F.col("n") / F.col("pool") > fraction).alias("broad"))


def convergence(n_support: Column, n_discriminating: Column) -> Column:
    """none under two channels; discriminating, mixed or broad_only by how many tell keys apart."""
    return (
        F.when(n_support < 2, "none")
        .when(n_discriminating >= 2, "discriminating")
        .when(n_discriminating == 1, "mixed")
        .otherwise("broad_only")
    )


def aggregate(rankings: DataFrame, channels: int) -> DataFrame:
    """One row per key: score, p, support, convergence."""
    ranks = normalised_ranks(rankings)
    rra = robust_rank_aggregation(ranks, channels)
    support = ranks.join(F.broadcast(broad_channels(ranks)), "channel").groupBy("key").agg(F.count_if(~F.col("broad")).alias("n_discriminating"))
    return rra.join(support, "key").withColumn("convergence", convergence(F.col("n_support"), F.col("n_discriminating")))


def enrichment(ranked: DataFrame, depths: list[int]) -> DataFrame:
    """``k, found, total``: positives among the first k positions."""
    total = ranked.agg(*[F.count_if(F.col("is_positive") & (F.col("position") <= k)).alias(f"k{k}") for k in depths], F.count_if("is_positive").alias("total"))
    return total.select("total", F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.col(f"k{k}").alias("found")) for k in depths])).alias("x")).select("x.k", "x.found", "total")


def negative_fractions(ranked: DataFrame) -> DataFrame:
    """Per positive the share of negatives below it: ``idx, position, fraction``.

    Positions are 1 to n without gaps, so negatives above a positive are its
    position less the positives up to it: only positives are ordered.
    """
    totals = ranked.agg(F.count("*").alias("n"), F.count_if("is_positive").alias("np"))
    pos = numbered(ranked.filter("is_positive").select("position"), ["position"], name="idx")
    above = (F.col("position") - 1) - (F.col("idx") - 1)
    negatives = F.col("n") - F.col("np")
    return pos.join(F.broadcast(totals)).select("idx", "position", F.try_divide(negatives - above, negatives).alias("fraction"))


def auroc(ranked: DataFrame) -> DataFrame:
    """One row: the mean fraction; NULL without negatives."""
    return negative_fractions(ranked).agg(F.avg("fraction").alias("auroc"), F.count("*").alias("n_positives"))


def bootstrap(ranked: DataFrame, samples: int, seed: int, lo: float = 0.025, hi: float = 0.975) -> DataFrame:
    """One row: percentile interval of the mean fraction over resampled positives.

    At most one positive gives no interval.  Draws are stateless, so they are dealt out by
    number, ``DRAWS`` a task, however few tasks the positives lie in; the positives' own table is
    broadcast below Spark's threshold and shuffled beyond it.
    """
    pos = cut(negative_fractions(ranked).select(F.col("idx").alias("pick"), "fraction"))
    m = pos.count()
    parts = max(ranked.sparkSession.sparkContext.defaultParallelism, m * samples // DRAWS + 1)
    draws = ranked.sparkSession.range(0, m * samples, 1, parts).selectExpr(f"id % {samples} AS sample", f"id DIV {samples} + 1 AS idx")
    picked = draws.select("sample", (draw(seed, F.col("sample"), F.col("idx")) % F.lit(max(m, 1)) + 1).alias("pick"))
    means = picked.join(pos, "pick").groupBy("sample").agg(F.avg("fraction").alias("a"))
    line = means.agg(F.sort_array(F.collect_list("a")).alias("a"))  # a number a sample

    def at(q):
        return F.when(F.lit(m > 1), F.round(F.get("a", F.lit(int(q * (samples - 1)))), 4))

    return line.select(at(lo).alias("lo"), at(hi).alias("hi"), F.lit(m).cast("bigint").alias("n_positives"))
