"""Column builders of the allele-ratio model.

Shares are read as shifts of a ratio from one half; noise folds the shift, and a
bisection unfolds it.  Missing is NULL and never zero.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ceilings of the two models and the screens' limits.
MAX_DEV_GAIN = 1 / 6
MAX_DEV_LOSS = 0.5
HEMIZYGOUS_HET_FRACTION = 0.20
MIN_INFORMATIVE_SITES = 200
CONTAMINATED = 0.12
#: Steps of the bisection, the same in every engine that repeats it.
STEPS = 30
SERIES_TERMS = 120
TOP = 0.4999


def baf(ref: Column, alt: Column) -> Column:
    """Share of the alternative reads; NULL without coverage."""
    return F.try_divide(alt.cast("double"), (ref + alt).cast("double"))


def mosaic_fraction(dev: Column, gain: bool) -> Column:
    """Cell fraction that explains a shift; NULL above what a clonal event can do."""
    fraction = 4 * dev / (1 - 2 * dev) if gain else 4 * dev / (1 + 2 * dev)
    return F.when(dev <= 0, 0.0).when(dev <= (MAX_DEV_GAIN if gain else MAX_DEV_LOSS) + 1e-12, F.least(F.lit(1.0), fraction))


def infer_sex(het_fraction: Column, n_sites: Column) -> Column:
    return (
        F.when(n_sites < MIN_INFORMATIVE_SITES, "undetermined")
        .when(het_fraction < HEMIZYGOUS_HET_FRACTION, "XY")
        .otherwise("XX")
    )


def contamination(baseline: Column) -> Column:
    return F.when(baseline <= 0, "unknown").when(baseline > CONTAMINATED, "suspect").otherwise("clean")


def sigma_at_depth(depth: Column) -> Column:
    return F.when(depth > 0, 0.5 / F.sqrt(depth))


def erf(z: Column) -> Column:
    """Error function of z >= 0 by its series of positive terms.

    Each term is the one before times 2 z^2 / (2n + 1); accurate to 1e-14 for z < 6.
    """
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.struct(z.alias("t"), z.alias("s")),
        lambda a, n: F.struct((a["t"] * 2 * z * z / (2 * n + 1)).alias("t"), (a["s"] + a["t"] * 2 * z * z / (2 * n + 1)).alias("s")),
        lambda a: a["s"],
    )
    return F.lit(2 / math.sqrt(math.pi)) * F.exp(-z * z) * total


def folded_mean(delta: Column, sigma: Column) -> Column:
    """Mean distance from the centre of a normal that is shifted by ``delta``."""
    z = delta / (sigma * math.sqrt(2.0))
    return sigma * math.sqrt(2 / math.pi) * F.exp(-z * z) + delta * erf(z)


def deconvolve_shift(statistic: Column, sigma: Column) -> Column:
    """The shift whose folded mean is ``statistic``: 0 under the noise, NULL above the range."""
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        F.struct(F.lit(0.0).alias("lo"), F.lit(TOP).alias("hi")),
        lambda b, _: F.when(
            folded_mean((b["lo"] + b["hi"]) / 2, sigma) < statistic,
            F.struct(((b["lo"] + b["hi"]) / 2).alias("lo"), b["hi"].alias("hi")),
        ).otherwise(F.struct(b["lo"].alias("lo"), ((b["lo"] + b["hi"]) / 2).alias("hi"))),
        lambda b: (b["lo"] + b["hi"]) / 2,
    )
    floor = sigma * math.sqrt(2 / math.pi)
    return (
        F.when((sigma <= 0) | sigma.isNull() | statistic.isNull(), None)
        .when(statistic <= floor, 0.0)
        .when(statistic >= folded_mean(F.lit(TOP), sigma), None)
        .otherwise(found)
    )


def excess_shift(statistic: Column, baseline: Column, sigma: Column) -> Column:
    """Shift over the baseline's own, not below 0; NULL where either is."""
    over = deconvolve_shift(statistic, sigma) - deconvolve_shift(baseline, sigma)
    return F.when(over.isNotNull(), F.greatest(F.lit(0.0), over))


def detection_limit(baseline: Column, sd: Column, sigma: Column, z: float = 5.0) -> Column:
    """The least fraction (gain) at which a window reaches ``z``; NULL without scatter or noise."""
    delta = excess_shift(baseline + z * sd, baseline, sigma)
    return F.when((sd > 0) & (sigma > 0), mosaic_fraction(delta, True))
