"""Exact quantiles of groups of any size.

A sketch of bounded size brackets each quantile, a histogram of fixed width inside the
bracket finds the one bin that holds it, and only that bin's distinct values are put in
order.  So no task holds a group's values, however large it is and wherever they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The sketch's error is at most a share 1 / ACCURACY of a group; bins of a bracket.
ACCURACY, BINS = 10_000, 4096


def quantiles(rows: DataFrame, value: str, probs: list[float], by: list[str] | None = None, accuracy: int = ACCURACY, bins: int = BINS) -> DataFrame:
    """``by..., n, quantiles``: linearly interpolated quantiles at ``probs`` of non-null finite values.

    ``rows`` is read three times: let it be a table.  A group without values has no row; null groups
    are groups.
    """
    by = by or []
    names = [f"__by{i}" for i in range(len(by))]
    own = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(by, names)], F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    slack = 2.0 / accuracy
    ends = [end for p in probs for end in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = own.groupBy(*names).agg(F.count("*").alias("n"), F.percentile_approx("v", ends, accuracy).alias("ends"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), F.col("ends")[2 * i].alias("lo"), F.col("ends")[2 * i + 1].alias("hi")) for i, p in enumerate(probs)])
    brackets = sketch.select(*names, "n", F.explode(wanted).alias("x")).select(*names, "n", "x.*")  # a row a group and quantile
    place = F.col("p") * (F.col("n") - 1)
    brackets = brackets.withColumn("rank", F.floor(place)).withColumn("part", place - F.floor(place))

    def met(small: DataFrame) -> DataFrame:
        right = small.select(*[F.col(n).alias(f"__r{n}") for n in names], *[c for c in small.columns if c not in names])
        same = F.lit(True)
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"__r{n}"))
        return own.join(right if names else F.broadcast(right), same).drop(*[f"__r{n}" for n in names])  # without groups a row a quantile

    width = F.col("hi") - F.col("lo")
    inside = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width * bins), F.lit(bins - 1))).otherwise(0)
    slot = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), bins).otherwise(inside).cast("int")
    # bins + 2 counts a group and quantile
    histogram = met(brackets).groupBy(*names, "i", "n", "p", "lo", "hi", "rank", "part", slot.alias("slot")).agg(F.count("*").alias("m"), F.min("v").alias("least"))
    line = Window.partitionBy(*names, "i").orderBy("slot")
    upto = histogram.withColumn("before", F.sum("m").over(line) - F.col("m")).withColumn("next", F.lead("least").over(line))
    chosen = upto.filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("m"))).select(*names, "i", "n", "lo", "hi", "rank", "part", "slot", "before", "next")
    counts = met(chosen).filter(slot == F.col("slot")).groupBy(*names, "i", "n", "rank", "part", "before", "next", "v").agg(F.count("*").alias("m"))
    order = Window.partitionBy(*names, "i").orderBy("v")
    running = counts.withColumn("upto", F.col("before") + F.sum("m").over(order))
    low = F.min(F.when(F.col("upto") > F.col("rank"), F.col("v")))
    high = F.coalesce(F.min(F.when(F.col("upto") > F.col("rank") + 1, F.col("v"))), F.first("next"), low)
    found = running.groupBy(*names, "i", "n", "part").agg(low.alias("low"), high.alias("high"))
    at = F.when(F.col("part") == 0, F.col("low")).otherwise(F.col("low") * (1 - F.col("part")) + F.col("high") * F.col("part"))
    listed = found.groupBy(*names).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", at.alias("q")))).alias("q")).filter("n IS NOT NULL")
    return listed.select(*[F.col(n).alias(c) for c, n in zip(by, names)], "n", F.transform("q", lambda x: x["q"]).alias("quantiles"))
