"""Joins of positions with regions, with keys of their own and with near positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut

#: Widths of bins: a region lies on those of the first level that is not narrower than itself.
FINEST, FACTOR, LEVELS = 4096, 8, 12
#: Bins of counts: the first level's hold 2 ** LEAF positions, each other's are 2 ** BITS times as wide as those below; levels that one job counts.
LEAF, BITS, AT_ONCE = 6, 2, 4


def in_regions(points: DataFrame, regions: DataFrame, pad: int, finest: int = FINEST) -> DataFrame:
    """Points with every padded region that holds them.

    Bins come in levels, each ``FACTOR`` times as wide as the one below.  A region is a row in
    each of the one or two bins that it meets on its own level, whatever its length; a point is a row on each
    level that regions use.  The join has an equality on (contig, level, bin), so it stays
    a hash or merge join at any size; the exact bounds follow as a condition.
    """
    r = regions.select("contig", "gene", (F.col("start") - pad).alias("lo"), (F.col("end") + pad).alias("hi")).filter("lo <= hi")
    width = F.col("hi") - F.col("lo")
    level = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        level = F.when(width <= finest * FACTOR**k, k).otherwise(level)

    def size(level):
        return (F.lit(finest) * F.pow(F.lit(FACTOR), level)).cast("long")

    def bin_of(place, level):  # whole numbers, and below zero too
        return F.call_function("div", place - F.pmod(place, size(level)), size(level))

    laid = r.withColumn("level", level.cast("int")).withColumn("bin", F.explode(F.sequence(bin_of(F.col("lo"), F.col("level")), bin_of(F.col("hi"), F.col("level")))))
    used = sorted(x["level"] for x in laid.select("level").distinct().collect())  # at most LEVELS + 1
    levels = F.array(*[F.lit(k) for k in used]) if used else F.array().cast("array<int>")
    keyed = points.withColumn("level", F.explode(levels)).withColumn("bin", bin_of(F.col("pos").cast("long"), F.col("level")))
    return keyed.join(laid, ["contig", "level", "bin"]).filter("pos BETWEEN lo AND hi").drop("level", "bin", "lo", "hi")


def _covered(lo: Column, hi: Column, levels: int) -> Column:
    """For each level the bins, 4 times as wide as the level's below, that make up [lo, hi] exactly: at most seven."""

    def edge(k):  # the first whole bin of level k, and the first one after the last
        return F.shiftright(lo + ((1 << BITS * k) - 1), BITS * k), F.shiftright(hi + 1, BITS * k)

    def run(start, end):
        return F.when(start < end, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))

    each = []
    for k in range(levels):
        (a, e), (a_up, e_up) = edge(k), edge(k + 1)
        whole = run(a, e)
        if k < levels - 1:
            ends = F.concat(run(a, F.shiftleft(a_up, BITS)), run(F.shiftleft(e_up, BITS), e))
            whole = F.when(a_up >= e_up, whole).otherwise(ends)
        each.append(whole)
    return F.array(*each)


def totals_in_regions(points: DataFrame, regions: DataFrame, pad: int) -> DataFrame:
    """``gene, n_points, first_id``: how many points a gene's padded regions hold, and the least id; genes without points are left out.

    A pair of a point and a region is no row.  Points are counted by position and by bins of width 64, 256, 1024 and so on.
    A region of any length is made up of a few bins of each width, and of positions in the two of width 64 where it
    begins and ends, so both sides and their join grow with the rows and the logarithm of a region.
    They are joined by a merge.  Positions are whole numbers.
    """
    least = F.sum("n").alias("n"), F.min("id").alias("id")
    base = cut(points.select("contig", F.col("pos").cast("long").alias("pos"), "id").filter("pos IS NOT NULL").groupBy("contig", "pos").agg(F.count("*").alias("n"), F.min("id").alias("id")))
    span = base.agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
    first, last = (0, -1) if span["lo"] is None else (span["lo"], span["hi"])
    held = base.select("contig", F.lit(0).alias("level"), F.shiftright("pos", LEAF).alias("bin"), "pos", "n", "id")
    top = cut(held.groupBy("contig", F.lit(1).alias("level"), "bin").agg(*least))
    held, levels = held.unionByName(top, allowMissingColumns=True), 2
    while (last >> LEAF) - (first >> LEAF) >= 1 << BITS * (levels - 2):  # a few levels a table, the next ones from its widest bins
        up = F.explode(F.array(*[F.struct(F.lit(levels - 1 + j).alias("level"), F.shiftright("bin", BITS * j).alias("bin")) for j in range(1, AT_ONCE + 1)]))
        more = cut(top.select("contig", up.alias("x"), "n", "id").groupBy("contig", "x.level", "x.bin").agg(*least))
        levels += AT_ONCE
        held, top = held.unionByName(more, allowMissingColumns=True), more.filter(F.col("level") == levels - 1)
    r = regions.select("contig", "gene", (F.col("start") - pad).alias("lo"), (F.col("end") + pad).alias("hi")).filter("lo <= hi")
    # no further than points lie
    r = r.withColumns({"lo": F.greatest(F.col("lo"), F.lit(first)), "hi": F.least(F.col("hi"), F.lit(last))}).filter("lo <= hi")
    # regions are few bytes and many bins: dealt out before they grow, and never broadcast, as estimates see no bins
    r = r.repartition("gene", "lo", "hi")
    begin, end = F.shiftright("lo", LEAF), F.shiftright("hi", LEAF)
    bins = F.concat(F.array(F.array_distinct(F.array(begin, end))), _covered(begin + 1, end - 1, levels - 1))
    laid = r.select("contig", "gene", "lo", "hi", F.posexplode(bins).alias("level", "bins")).select("contig", "gene", "lo", "hi", "level", F.explode("bins").alias("bin"))
    # the first key is what sorting compares first: bins differ most
    met = laid.hint("merge").join(held, ["bin", "level", "contig"]).filter("level > 0 OR pos BETWEEN lo AND hi")
    return met.groupBy("gene").agg(F.sum("n").alias("n_points"), F.min("id").alias("first_id"))


def first_region(points: DataFrame, regions: DataFrame, pad: int) -> DataFrame:
    """Per point the region of the first name that holds it; points in none are left out, repeated ones stay."""
    numbered = points.withColumn("__row", F.monotonically_increasing_id())
    return in_regions(numbered, regions, pad).groupBy("__row", *points.columns).agg(F.min("gene").alias("gene")).drop("__row")


def near(points: DataFrame, sites: DataFrame, reach: int) -> DataFrame:
    """Pairs (point, site) of one contig within ``reach``: each point looks in three bins."""
    p = points.withColumn("bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("pos") / reach) + d)))
    s = sites.select("contig", F.col("pos").alias("site_pos"), *[c for c in sites.columns if c not in ("contig", "pos")])
    s = s.withColumn("bin", F.floor(F.col("site_pos") / reach))
    return p.join(s, ["contig", "bin"]).filter(F.abs(F.col("pos") - F.col("site_pos")) <= reach).drop("bin")


def pairs_within(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Pairs (a, b) of rows of one group with a before b; groups are small by construction."""
    a = rows.select(F.col(group), F.struct("*").alias("a"))
    b = rows.select(F.col(group), F.struct("*").alias("b"))
    return a.join(b, group).filter(F.col(f"a.{order}") < F.col(f"b.{order}"))


def best_on(rows: DataFrame, group: list[str], *order) -> DataFrame:
    """The first row of each group in the given order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
