"""Connectivity of signatures (arrays of scores) with up and down queries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.draws import draw, without_replacement
from .order import numbered
from .quantiles import quantiles
from .tables import cut

#: Signatures of a tile at least: a task multiplies two of them.
TILE = 256
#: Tiles of a group up to which tiles grow with it, and signatures of a tile at most.
TILES, WIDEST = 16, 1 << 16
#: Products of a piece of a result.
PIECE = 1 << 20


def ranked(signatures: DataFrame) -> DataFrame:
    """Long form, each signature's genes in descending order: ``sig, grp, gene, z, pos, n``.

    Ties go to the lower gene.  One array holds a signature, so ordering it needs
    no shuffle.
    """
    order = F.array_sort(
        F.transform("z", lambda v, i: F.struct((-v.cast("double")).alias("neg"), i.alias("gene")))
    )
    return signatures.select("sig", "grp", F.posexplode(order).alias("pos", "x"), F.size("z").alias("n")).select(
        "sig", "grp", F.col("x.gene").alias("gene"), (-F.col("x.neg")).alias("z"), "pos", "n"
    )


def running_sum(ranks: DataFrame, members: DataFrame) -> DataFrame:
    """Weighted running-sum score per (query, sig) of the genes in ``members`` (query, gene).

    The first position of the largest absolute deviation decides; a signature
    without weight on the members scores 0, one that has none of them no row.
    Between two members the sum only falls, so its extremes lie at a member or
    just before one: the join on genes brings those alone, not every gene of
    every pair.
    """
    hits = ranks.join(members.select("query", "gene"), "gene").withColumn("w", F.abs("z"))
    per = Window.partitionBy("query", "sig").orderBy("pos")
    every = Window.partitionBy("query", "sig")
    walked = hits.select(
        *("query", "sig", "grp", "pos"),
        F.sum("w").over(every).alias("total"), F.sum("w").over(per).alias("upto"), F.col("w"),
        F.try_divide(F.col("pos") - F.row_number().over(per) + 1, F.col("n") - F.count("*").over(every)).alias("missed"),
    )

    def at(weight, pos):
        dev = F.coalesce(F.try_divide(weight, F.col("total")), F.lit(0.0)) - F.coalesce("missed", F.lit(0.0))
        return F.struct(F.round(dev, 12).alias("dev"), pos.alias("pos"))

    places = F.array(at(F.col("upto") - F.col("w"), F.col("pos") - 1), at(F.col("upto"), F.col("pos")))
    tried = walked.select("query", "sig", "grp", "total", F.explode(places).alias("x")).filter("x.pos >= 0")
    best = F.max_by("x.dev", F.struct(F.abs("x.dev"), -F.col("x.pos")))
    return tried.groupBy("query", "sig", "grp").agg(F.when(F.max("total") > 0, best).otherwise(0.0).alias("es"))


def connectivity(ranks: DataFrame, tails: DataFrame) -> DataFrame:
    """``query, sig, grp, wtcs`` for tails (query, tail, gene): half the difference of signs that differ."""
    up = running_sum(ranks, tails.filter("tail = 'up'").select("query", "gene")).withColumnRenamed("es", "es_up")
    down = running_sum(ranks, tails.filter("tail = 'down'").select("query", "gene")).withColumnRenamed("es", "es_down")
    both = up.join(down, ["query", "sig", "grp"])
    return both.withColumn("wtcs", F.when(F.signum("es_up") == F.signum("es_down"), 0.0).otherwise((F.col("es_up") - F.col("es_down")) / 2))


def normalise(scores: DataFrame) -> DataFrame:
    """Adds ``ncs``: the score over the mean magnitude of its group and sign; 0 stays 0."""
    w = Window.partitionBy("query", "grp", F.signum("wtcs"))
    return scores.withColumn("ncs", F.when(F.col("wtcs") == 0, 0.0).otherwise(F.col("wtcs") / F.avg(F.abs("wtcs")).over(w)))


def max_quantile(scores: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``by..., score``: of the 33 and 67 per cent points of a group's values the one of larger magnitude, ties high."""
    q = F.col("quantiles")
    return quantiles(cut(scores.select(*by, value)), value, [0.33, 0.67], by).select(*by, F.when(F.abs(q[1]) >= F.abs(q[0]), q[1]).otherwise(q[0]).alias("score"))


def consensus(signatures: DataFrame, by: str) -> DataFrame:
    """Mean score per gene over the signatures of each value of ``by``: ``query, gene, z``."""
    long = signatures.select(F.col(by).alias("query"), F.posexplode("z").alias("gene", "z"))
    return long.groupBy("query", "gene").agg(F.avg("z").alias("z"))


def query_tails(means: DataFrame, size: int) -> DataFrame:
    """The ``size`` highest and lowest genes of each query, ties by gene; the tails must not meet."""
    n = Window.partitionBy("query")
    high = F.row_number().over(n.orderBy(F.desc("z"), "gene"))
    low = F.row_number().over(n.orderBy("z", F.desc("gene")))
    r = means.withColumn("h", high).withColumn("l", low).withColumn("n", F.count("*").over(n))
    ok = F.assert_true(F.col("n") > 2 * size, F.lit("tails overlap")).isNull()
    return r.filter(ok & ((F.col("h") <= size) | (F.col("l") <= size))).select("query", "gene", F.when(F.col("h") <= size, "up").otherwise("down").alias("tail"))


def random_tails(spark: SparkSession, genes: int, size: int, queries: int, seed: int) -> DataFrame:
    """``query, gene, tail`` of ``queries`` random queries (from 1): ``size`` genes up and as many others down."""
    q = spark.range(1, queries + 1).select(F.col("id").alias("query"))
    both = F.array(*[draw(seed, F.col("query"), F.lit(i)) % F.lit(genes - i) for i in range(2 * size)]).cast("array<bigint>")
    ups = F.array(*[draw(seed + 1, F.col("query"), F.lit(i)) % F.lit(2 * size - i) for i in range(size)]).cast("array<bigint>")
    drawn = q.select("query", without_replacement(ups).alias("ups"), F.posexplode(without_replacement(both)).alias("k", "gene"))
    return drawn.select("query", F.col("gene").cast("int").alias("gene"), F.when(F.array_contains("ups", F.col("k").cast("long")), "up").otherwise("down").alias("tail"))


def deflate(vectors: DataFrame, axis: DataFrame) -> DataFrame:
    """Removes a direction from each query's centred vector: ``query, gene, z, r_before``."""
    centred = vectors.withColumn("c", F.col("z") - F.avg("z").over(Window.partitionBy("query")))
    a = axis.withColumn("a", F.col("z") - F.avg("z").over(Window.partitionBy(F.lit(1)))).select("gene", "a")
    joined = centred.join(a, "gene")
    w = Window.partitionBy("query")
    along = F.sum(F.col("c") * F.col("a")).over(w) / F.sum(F.col("a") * F.col("a")).over(w)
    return joined.select("query", "gene", (F.col("c") - along * F.col("a")).alias("z"), F.corr("c", "a").over(w).alias("r_before"), F.col("a"))


def ladder(scores: DataFrame, depths: list[int]) -> DataFrame:
    """``query, depth, score``: the depth-th lowest score of each query."""
    w = Window.partitionBy("query").orderBy("score", "key")
    return scores.withColumn("depth", F.row_number().over(w)).filter(F.col("depth").isin(depths)).select("query", F.col("depth").cast("bigint").alias("depth"), "score")


def passing_depth(rungs: DataFrame, observed: str, p_max: float) -> DataFrame:
    """Per depth the empirical p of the observed query among all others, and whether it passes."""
    obs = rungs.filter(F.col("query").cast("string") == observed).select("depth", F.col("score").alias("obs"))
    null = rungs.filter(F.col("query").cast("string") != observed)
    p = (F.count_if(F.col("score") <= F.col("obs")) + 1) / (F.count("*") + 1)
    return null.join(obs, "depth").groupBy("depth").agg(p.alias("p")).withColumn("passes", F.col("p") <= p_max)


def spearman(signatures: DataFrame, tile: int = TILE, tiles: int = TILES) -> DataFrame:
    """Rank correlation of each pair (a before b) of signatures of one group; average ranks for ties.

    A signature travels as its ranks, doubled to whole numbers; a task makes vectors of them, centred and of length 1.
    The signatures of a group are numbered and cut into tiles of at least ``tile``, and a task multiplies
    two tiles: a vector is copied once for each tile of its group, not for each partner.  Tiles grow
    with their group up to ``WIDEST``, so copies are at most ``tiles`` + 1 up to there, and the
    shuffle grows with the rows.  Signatures of other lengths are
    groups of their own; a constant one has no correlation (NULL).  The result is quadratic
    in a group: groups are replicates of one treatment.
    """
    kind = signatures.schema["sig"].dataType.simpleString()

    @F.pandas_udf("array<int>")
    def doubled(vectors: pd.Series) -> pd.Series:
        each = [2 * pd.Series(v, dtype=float).rank().to_numpy() for v in vectors]
        return pd.Series([np.rint(r if not np.isnan(r).any() else np.zeros(len(r))).astype(np.int32) for r in each])

    def units(ranks: pd.Series) -> np.ndarray:
        r = np.vstack(ranks.to_numpy()).astype(float) / 2
        r = r - r.mean(axis=1, keepdims=True)
        size = np.sqrt((r * r).sum(axis=1, keepdims=True))
        return np.where(size > 0, r / np.where(size > 0, size, 1.0), np.nan)

    def product(keys: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches))
        _, _, i, j = keys
        x = pdf if i == j else pdf[pdf["t"] == i]
        y = pdf if i == j else pdf[pdf["t"] == j]
        if x.empty or y.empty:
            return
        u, v = units(x["r"]), units(y["r"])
        step = max(1, PIECE // len(y))
        for k in range(0, len(x), step):  # a piece of the result at a time
            rho = u[k : k + step] @ v.T
            a, b = np.broadcast_arrays(x["sig"].to_numpy()[k : k + step, None], y["sig"].to_numpy()[None, :])
            lower = a < b
            once = lower if i == j else np.ones(a.shape, bool)
            values = rho[once]
            yield pd.DataFrame({"a": np.where(lower, a, b)[once], "b": np.where(lower, b, a)[once], "rho": pd.array(np.where(np.isnan(values), None, values), dtype="Float64")})

    rows = signatures.select("sig", "grp", F.size("z").alias("size"), "z").filter("size > 0").select("sig", "grp", "size", doubled("z").alias("r"))
    met = _dealt(numbered(rows, ["sig"], by=["grp", "size"], name="nth"), tile, tiles)
    keys = ["grp", "size", "i", "j"]
    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes make many products: not to be coalesced
    return met.repartition(parts, *keys).groupBy(*keys).applyInPandas(product, f"a {kind}, b {kind}, rho double")


def _dealt(rows: DataFrame, tile: int, tiles: int) -> DataFrame:
    """``rows`` (grp, size, nth, sig, r) once for each tile of their group: ``i, j`` are the tiles that meet, ``t`` the row's own."""
    wide = F.least(F.greatest(F.lit(tile), F.ceil(F.max("nth") / tiles)), F.lit(max(tile, WIDEST)))
    groups = rows.groupBy("grp", "size").agg(F.max("nth").alias("n"), wide.alias("wide"))  # a row a group
    placed = rows.join(groups, ["grp", "size"]).withColumns({"t": F.floor((F.col("nth") - 1) / F.col("wide")).cast("int"), "last": F.floor((F.col("n") - 1) / F.col("wide")).cast("int")})
    met = placed.select("grp", "size", "t", "sig", "r", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    return met.select("grp", "size", F.least("t", "other").alias("i"), F.greatest("t", "other").alias("j"), "t", "sig", "r")
