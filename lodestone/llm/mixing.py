"""Mixing sources to target weights along a time-varying curriculum.

Targets come from the sources' weights by filling up: sources whose share would
exceed the most they may give stop there, and what is left over is shared among
the others by weight.  With sources ordered by limit over weight the full ones
are a prefix, so one ordered pass over the sources finds the level.

Each source lays its documents, in hash order, on a line of words, again and
again until its target is met.  Its weight over training time t in [0, 1] runs
linearly from ``target * (1 + tilt)`` to ``target * (1 - tilt)``; the integral is
the demand for its words up to t, and inverting that demand at a document's
offset gives the document's position.  The mix is all documents range-sorted by
position.  Offsets come from two levels of sums, per bucket and inside a bucket,
so a source of any size is spread over many tasks.  Hashes are md5 of values, so
SQL computes the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, draw, draw_sql, stored

MOST_REPEATS = 3
BUCKETS = 1024
TILT, SEED = 0.5, 7


def cycled_weights(ordinal: Column) -> Column:
    """1, 2, 3, 1, … for sources in order (ordinal from 0)."""
    return (ordinal % 3 + 1).cast("double")


def source_targets(sizes: DataFrame, weight=cycled_weights, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``target`` to rows of ``source, source_size``: one row per source."""
    ordered = sizes.withColumn("w", weight(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1))
    ratio = F.col("source_size") * most / F.col("w")
    line = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    rest = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # one row a source: the few aggregates here need no partitions
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ordered.withColumn("fill", ratio).select(
        "*",
        F.row_number().over(line).alias("nth"),
        F.sum("source_size").over(every).alias("total"),
        # the level at which this source and all after it share what the sources before it leave
        ((F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))) / F.sum("w").over(rest)).alias("level"),
    )
    # the first source that the level does not fill ends the full ones
    settled = levels.withColumn("cut", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("nth", "level"))).over(every))
    target = F.least(F.col("source_size") * F.lit(float(most)), F.col("w") * F.col("cut.level"))
    return settled.select(*sizes.columns, target.alias("target"))


def _bucketed(docs: DataFrame, text: str, id_col: str, source: str, buckets: int) -> DataFrame:
    rows = docs.withColumn("__size", count_words(F.col(text)))
    rows = rows.withColumn("__h", draw(F.col(id_col), F.col(source), F.col("__size")))
    # a name for the source that is never null: windows and joins then share one partitioning
    rows = rows.withColumn("__s", F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source).cast("string"))))
    return rows.withColumn("__b", F.pmod(F.shiftright("__h", 20), F.lit(buckets)).cast("int"))


def plan(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    weight=cycled_weights,
    most: int = MOST_REPEATS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``offset``, ``key`` and ``repeats``.

    ``key`` tells documents of one id apart.  ``repeats`` is how often the mix takes the document: all full rounds of its
    source's target, and one more if the middle of the document lies within what
    is left of it, so a source misses its target by half a document at most.
    Null texts have size 0; a null source is a source of its own, the last;
    documents of a source without words are taken by no target.  Documents of one
    id, source and size are ordered by a hash of their texts, so reruns agree; rows
    equal in all of these are interchangeable.
    """
    rows = _bucketed(docs, text, id_col, source, buckets)
    # one pass over the texts: a row a source and bucket, used twice
    sums = stored(rows.groupBy("__s", "__b").agg(F.sum("__size").alias("words")))
    up_to = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("words").over(up_to), F.lit(0)))
    sizes = sums.groupBy("__s").agg(F.sum("words").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(F.col("__s") != "-", F.substring("__s", 2, 1 << 30)))
    targets = source_targets(sizes, weight, most).select("__s", F.col("source_size").alias("__total"), F.col("target").alias("__target"))
    starts = starts.select("__s", "__b", "__start").join(targets, "__s")
    rows = rows.withColumn("__t", F.xxhash64(F.col(text)))
    inside = Window.partitionBy("__s", "__b").orderBy("__h", F.col(id_col).asc_nulls_last(), "__size", "__t")
    rows = rows.withColumn("__inside", F.coalesce(F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("__key", F.struct("__s", "__b", F.row_number().over(inside).alias("nth")))
    found = rows.join(starts, ["__s", "__b"])
    offset = F.col("__start") + F.col("__inside")
    rounds = F.coalesce(F.floor(F.try_divide(F.col("__target"), F.col("__total"))), F.lit(0)).cast("int")
    found = found.withColumn("__offset", offset).withColumn("__rounds", rounds)
    left = F.col("__target") - F.col("__rounds") * F.col("__total")
    extra = F.when((F.col("__size") > 0) & (F.col("__offset") + F.col("__size") / 2 <= left), 1).otherwise(0)
    return found.withColumn("__repeats", F.col("__rounds") + extra).drop("__h", "__t", "__s", "__b", "__inside", "__start", "__rounds")


def position(offset: Column, target: Column, tilt: Column) -> Column:
    """The time t at which a source's demand reaches ``offset`` words.

    Demand D(t) = target * ((1 + tilt) * t - tilt * t^2); the root in [0, 1].
    """
    share = F.least(F.greatest(offset / target, F.lit(0.0)), F.lit(1.0))
    root = F.sqrt(F.greatest((1 + tilt) * (1 + tilt) - 4 * tilt * share, F.lit(0.0)))
    return F.when(F.abs(tilt) < 1e-12, share).otherwise(2 * share / (1 + tilt + root))


def _placed(docs: DataFrame, tilt: float, seed: int, **options) -> DataFrame:
    """``plan`` with a row for every taking of a document: its ``__round`` and its position ``__at``.

    Sources tilt towards the start or the end of training by a hash of their
    name, within ``tilt``.  A document that is not taken keeps one row, its
    round and position null.
    """
    lean = (draw(F.lit(seed), F.col(options.get("source", "source"))) % 2001 - 1000) / F.lit(1000.0) * tilt
    taken = F.col("__repeats") > 0
    # a document without words is dealt at its offset
    rounds = plan(docs, **options).withColumn("__round", F.explode_outer(F.when(taken, F.sequence(F.lit(0), F.col("__repeats") - 1))))
    at = position(F.col("__offset") + F.col("__round") * F.col("__total"), F.col("__target"), lean)
    return rounds.withColumn("__at", F.when(taken, at))


def _ranged(rows: DataFrame, order: list, partitions: int | None = None) -> DataFrame:
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def mix(docs: DataFrame, tilt: float = TILT, seed: int = SEED, partitions: int | None = None, **options) -> DataFrame:
    """One row per document: its size, its source's size and target, the words taken, its positions.

    The takings are range-sorted with their texts as in ``curriculum``, and the
    words taken are counted in what has been moved.  Rows come in the order of
    their first positions, documents that are not taken last and without one.
    Columns of other names are not read; an empty table gives an empty mix.
    """
    id_col, text, source = options.get("id_col", "doc_id"), options.get("text", "text"), options.get("source", "source")
    placed = _placed(docs.select(id_col, text, source), tilt, seed, **options).select(
        F.col(id_col).alias("doc_id"),
        F.when(F.col("__round").isNotNull(), F.col(text)).alias("text"),  # what is not taken need not move
        *("__key", "__size", "__total", "__target", "__round", "__at"),
    )
    rows = _ranged(placed, [F.col("__at"), F.col("doc_id"), F.col("__round")], partitions)
    each = rows.groupBy("doc_id", "__key").agg(
        F.first("__size").alias("size"),
        F.first("__total").alias("source_size"),
        F.round(F.first("__target").cast("double"), 6).alias("target"),
        F.sum(count_words(F.col("text"))).alias("taken"),
        F.sort_array(F.collect_list("__at")).alias("__places"),
    )
    ordered = _ranged(each, [F.get("__places", F.lit(0)).asc_nulls_last(), F.col("doc_id"), F.col("__key")], partitions)
    return ordered.select("doc_id", "size", "source_size", "target", "taken", F.round(F.get("__places", F.lit(0)), 9).alias("position"), F.transform("__places", lambda x: F.round(x, 9)).alias("positions"))


def curriculum(docs: DataFrame, tilt: float = TILT, seed: int = SEED, partitions: int | None = None, **options) -> DataFrame:
    """The mix in training order: a row for every taking of a document.

    Columns are those of ``docs``.  Rows are range-sorted by position, ties by
    id and round.  Null, empty and repeated rows are dealt as ``plan`` says; an
    empty table gives an empty mix.
    """
    placed = _placed(docs, tilt, seed, **options).filter(F.col("__repeats") > 0)
    return _ranged(placed, [F.col("__at"), F.col(options.get("id_col", "doc_id")), F.col("__round")], partitions).select(*docs.columns)


SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
h AS (SELECT *, {draw_sql('doc_id', 'source', 'size')} AS h FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM s),
f AS (SELECT *, source_size * {MOST_REPEATS} / w AS fill FROM w),
l AS (SELECT *, row_number() OVER o AS nth,
  (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(CAST(sum(source_size * {MOST_REPEATS}) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM f WINDOW o AS (ORDER BY fill, source NULLS LAST)),
c AS (SELECT arg_min(level, nth) AS level FROM l WHERE level <= fill),
t AS (SELECT l.source, source_size, least(CAST(source_size * {MOST_REPEATS} AS DOUBLE), w * c.level) AS target, ({draw_sql(f"'{SEED}'", 'l.source')} % 2001 - 1000) / 1000.0::DOUBLE * {TILT}::DOUBLE AS tilt FROM l LEFT JOIN c ON true),
o AS (SELECT h.*, source_size, target, tilt, coalesce(CAST(sum(size) OVER (PARTITION BY h.source ORDER BY (h >> 20) % {BUCKETS}, h, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS place
  FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0) AS rounds FROM o),
x AS (SELECT *, rounds + CASE WHEN size > 0 AND place + size / 2 <= target - rounds * source_size THEN 1 ELSE 0 END AS takes FROM k),
p AS (SELECT *, list_transform(range(takes), lambda i: least(greatest((place + i * source_size) / target, 0.0), 1.0)) AS shares FROM x)
SELECT doc_id, size, source_size, round(target, 6) AS target, size * takes AS taken, round(list_extract(ps, 1), 9) AS position, list_transform(ps, lambda y: round(y, 9)) AS positions
FROM (SELECT *, list_transform(shares, lambda v: CASE WHEN abs(tilt) < 1e-12 THEN v ELSE 2 * v / (1 + tilt + sqrt(greatest((1 + tilt) * (1 + tilt) - 4 * tilt * v, 0.0))) END) AS ps FROM p)
"""
