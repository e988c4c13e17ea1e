"""Windows over positions, their robust baseline, scores and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.burden import baf
from .quantiles import quantiles
from .tables import cut, discard


def position_windows(sites: DataFrame, width: int, min_depth: int) -> DataFrame:
    """Counts and allele-ratio statistics per (contig, window) of passing sites.

    ``sites`` has contig, pos, ref, alt, het, passing.  Windows are keyed by
    ``pos div width``.  Depth and deviation are those of heterozygous sites.
    """
    kept = sites.filter("passing AND ref IS NOT NULL AND alt IS NOT NULL").filter(F.col("ref") + F.col("alt") >= min_depth)
    ratio = baf(F.col("ref"), F.col("alt"))
    het = F.col("het") & ratio.isNotNull()
    win = F.floor(F.col("pos") / width).cast("bigint")
    return (
        kept.withColumn("win", win)
        .groupBy("contig", "win")
        .agg(
            F.count("*").alias("n_sites"),
            F.count_if(het).alias("n_het"),
            F.avg(F.when(het, F.abs(ratio - 0.5))).alias("mean_abs_dev"),
            F.median(F.when(het, (F.col("ref") + F.col("alt")).cast("double"))).alias("median_dp"),
        )
        .select("contig", (F.col("win") * width).alias("start"), ((F.col("win") + 1) * width).alias("end"), "n_sites", "n_het", "mean_abs_dev", "median_dp")
    )


def robust_baseline(windows: DataFrame, min_het: int) -> DataFrame:
    """One row: median and scaled median absolute deviation of informative windows.

    Fewer than two windows give (0, 0).
    """
    devs = cut(windows.filter((F.col("n_het") >= min_het) & F.col("mean_abs_dev").isNotNull()).select("mean_abs_dev"))
    centre = quantiles(devs, "mean_abs_dev", [0.5]).select(F.col("quantiles")[0].alias("centre"))
    off = cut(devs.join(F.broadcast(centre)).select("centre", F.abs(F.col("mean_abs_dev") - F.col("centre")).alias("off")))  # one row
    spread = off.agg(F.first("centre").alias("centre"), F.count("*").alias("n_windows")).join(F.broadcast(quantiles(off, "off", [0.5]).select(F.col("quantiles")[0].alias("mad"))), how="left")
    few = F.col("n_windows") < 2
    found = spread.select(
        F.when(few, 0.0).otherwise(F.col("centre")).alias("baseline"),
        F.when(few, 0.0).otherwise(F.col("mad") * 1.4826).alias("sd"),
        "n_windows",
    )
    out = cut(found)  # one row, that scores and roll-ups read again
    discard(devs, off)
    return out


def score_windows(windows: DataFrame, baseline: DataFrame, min_het: int, threshold: float) -> DataFrame:
    """Adds ``z`` and ``verdict``; windows of too few sites get neither."""
    b = F.broadcast(baseline.select("baseline", "sd"))  # one row
    informative = (F.col("n_het") >= min_het) & F.col("mean_abs_dev").isNotNull()
    z = F.when(informative & (F.col("sd") > 0), (F.col("mean_abs_dev") - F.col("baseline")) / F.col("sd"))
    verdict = (
        F.when(~informative, "insufficient_sites")
        .when(F.col("z").isNull(), "unscored")
        .when(F.col("z") >= threshold, "imbalanced")
        .otherwise("baseline")
    )
    return windows.join(b).withColumn("z", z).withColumn("verdict", verdict).drop("baseline", "sd")


def contig_rollup(scored: DataFrame, baseline: DataFrame, min_run: int) -> DataFrame:
    """Per contig: windows, informative and flagged ones, the longest run of flags, a verdict.

    Runs are over informative windows in position order only.
    """
    informative = scored.filter("verdict <> 'insufficient_sites'").withColumn("flag", F.col("verdict") == "imbalanced")
    inside = Window.partitionBy("contig").orderBy("start")
    alike = Window.partitionBy("contig", "flag").orderBy("start")
    islands = informative.withColumn("island", F.row_number().over(inside) - F.row_number().over(alike))
    runs = islands.filter("flag").groupBy("contig", "island").agg(F.count("*").alias("n"))
    longest = runs.groupBy("contig").agg(F.max("n").alias("longest_run"))
    per = scored.groupBy("contig").agg(
        F.count("*").alias("n_windows"),
        F.count_if(F.col("verdict") != "insufficient_sites").alias("n_informative"),
        F.count_if(F.col("verdict") == "imbalanced").alias("n_flagged"),
        F.median(F.when(F.col("verdict") != "insufficient_sites", F.col("mean_abs_dev"))).alias("median_abs_dev"),
    )
    run = F.coalesce(F.col("longest_run"), F.lit(0)).cast("bigint")
    verdict = F.when(F.col("n_informative") == 0, "insufficient_sites").when(run < min_run, "baseline").otherwise("imbalanced")
    return (
        per.join(longest, "contig", "left")
        .join(F.broadcast(baseline.select("baseline")))
        .select(
            "contig", "n_windows", "n_informative", "n_flagged", run.alias("longest_run"), "median_abs_dev",
            F.greatest(F.lit(0.0), F.col("median_abs_dev") - F.col("baseline")).alias("excess"), verdict.alias("verdict"),
        )
    )


def het_fractions(sites: DataFrame, min_depth: int) -> DataFrame:
    """Share of heterozygous sites per contig, among passing sites of enough depth."""
    kept = sites.filter("passing").filter(F.col("ref") + F.col("alt") >= min_depth)
    return kept.groupBy("contig").agg(F.count("*").alias("n_sites"), (F.count_if("het") / F.count("*")).alias("het_fraction"))
