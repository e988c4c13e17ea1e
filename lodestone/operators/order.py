"""Positions of all rows in one order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut

_WITHIN = (1 << 33) - 1  # Spark's increasing ids: the partition above 33 bits, the row in it below


def numbered(rows: DataFrame, order: list, by: list[str] | None = None, name: str = "position") -> DataFrame:
    """``rows`` with their place, from 1, in ``order``, in each group of ``by``.

    Rows are dealt out and sorted by ranges of (``by``, ``order``) and written, so that their places
    in a partition stay; counts by partition and group, summed up, are where a
    partition begins.  A group of any size is spread over many tasks.  Ties that ``order``
    leaves are broken as the rows happen to lie, once.  Null groups are groups.
    """
    by = by or []
    keys = [F.col(f"`{c}`") for c in by] + [F.col(c) if isinstance(c, str) else c for c in order]
    laid = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()))
    part, at = F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND(F.lit(_WITHIN))
    names = [f"__by{i}" for i in range(len(by))]
    groups = [F.col(f"`{c}`").alias(n) for c, n in zip(by, names)]
    counts = laid.groupBy(part, *groups).agg(F.min(at).alias("__first"), F.count("*").alias("__n"))
    # a row a partition, and one more a group
    before = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", *names, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__start"))
    same = F.shiftright(laid["__id"], 33) == starts["__part"]
    for c, n in zip(by, names):
        same = same & laid[f"`{c}`"].eqNullSafe(starts[n])
    place = at + F.col("__start") + 1
    return laid.join(starts, same).select(*[laid[f"`{c}`"] for c in rows.columns if c != name], place.alias(name))
