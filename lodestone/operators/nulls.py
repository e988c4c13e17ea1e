"""Degree-matched resampling nulls and empirical p-values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import draw
from .order import numbered
from .tables import cut

#: Nodes of a block of a bin.
BLOCK = 256


def mean_distance(targets: DataFrame, distances: DataFrame) -> DataFrame:
    """Per key the mean distance over its targets that have one: ``key, d, n``."""
    used = targets.join(distances, "node")
    return used.groupBy("key").agg(F.avg("distance").alias("d"), F.count("*").alias("n"))


def matched_null(targets: DataFrame, bins: DataFrame, distances: DataFrame, draws: int, seed: int, block: int = BLOCK) -> DataFrame:
    """Per key and draw the mean distance of random nodes of the targets' bins.

    Every target is replaced by a node of its bin, chosen by a hash of seed,
    key, node and draw; nothing depends on the order of rows.  A bin's nodes lie in blocks of at most
    ``block`` in the order of their names, so a bin of any size is many small rows.  A bin of one
    block is met once a target and drawn from in place; only draws from larger bins are
    rows of a join.
    """
    pool = cut(numbered(bins.join(distances, "node").select("node", "bin", "distance"), ["node"], by=["bin"], name="nth"))
    at = F.col("nth") - 1
    laid = pool.groupBy("bin", F.floor(at / block).alias("blk")).agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "distance"))), lambda x: x["distance"]).alias("held"))
    sizes = pool.groupBy("bin").agg(F.count("*").alias("m"))
    used = targets.join(pool.select("node", "bin"), "node").join(sizes, "bin")
    perm = F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("perm")

    def i(m: Column) -> Column:
        return draw(seed, F.col("key"), F.col("node"), F.col("perm")) % m

    small = used.filter(F.col("m") <= block).join(laid.select("bin", "held"), "bin").select("key", "node", "m", "held", perm).select("key", "perm", F.get("held", i(F.col("m")).cast("int")).alias("distance"))
    large = used.filter(F.col("m") > block).select("key", "node", "bin", "m", perm).select("key", "perm", "bin", i(F.col("m")).alias("i"))
    large = large.withColumn("blk", F.floor(F.col("i") / block)).join(laid, ["bin", "blk"]).select("key", "perm", F.get("held", (F.col("i") % block).cast("int")).alias("distance"))
    return small.unionByName(large).groupBy("key", "perm").agg(F.avg("distance").alias("d"))


def z_scores(observed: DataFrame, null: DataFrame) -> DataFrame:
    """Adds the null's mean and sample deviation and z; no spread or one draw gives NULL."""
    stats = null.groupBy("key").agg(F.avg("d").alias("mean"), F.stddev_samp("d").alias("sd"))
    return observed.join(stats, "key", "left").withColumn("z", F.try_divide(F.col("d") - F.col("mean"), F.nullif("sd", F.lit(0.0))))


def empirical_p(extreme: Column, draws: Column) -> Column:
    return (extreme + 1) / (draws + 1)
