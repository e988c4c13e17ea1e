"""Divergence of sources within a language, by their term probabilities.

A language keeps the V terms of at least ``LEAST_DOCS`` of its documents.  A group
(language, source) gives each kept term ``p = 1 + floor(10^9 * (count + 1) / (N + V))``
with N its occurrences of kept terms.  The divergence of p from q is the sum of
``f = floor((p - q)^2 / q)`` over all kept terms, most of which a group lacks.

The sum is never taken term by term.  With p0 and q0 the values of an absent term,
inclusion-exclusion over the two supports gives it as

    V * f(p0, q0)                                        a constant of the pair
    + over counts c of the one:   n(c) * (f(p(c), q0) - f(p0, q0))
    + over counts d of the other: n(d) * (f(p0, q(d)) - f(p0, q0))
    + over terms of both: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

so a histogram of counts a group prices the one-sided terms, and only terms that both
groups hold are joined, posting by posting.

All arithmetic is exact in 64 bits: f is at most 10^18, sums of f over terms stay below
(10^9 + V)^2, and the division of p is carried out in three digits of 1000.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, term_bytes

LEAST_DOCS = 3
#: Ranks of terms that a group reports.
TOP_TERMS = 200
#: Distinct terms that a worker holds before it hands them on; changes no result.
HELD = 300_000
#: Parts in which a group's terms are ranked, and a language's histograms are priced.
SALTS = 32
COUNTS = "lang string, source string, term string, tf long, df long"


def _count(batches):
    """Occurrences and documents of terms, summed over what a worker can hold; a row without term for every group."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def rows():
        for (lang, source), (tf, df) in held.items():
            terms = list(tf)
            n = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array([*terms, None], pa.binary()).cast(pa.string()),
                    pa.array([*tf.values(), 0], pa.int64()),
                    pa.array([*map(df.__getitem__, terms), 0], pa.int64()),
                ],
                names=["lang", "source", "term", "tf", "df"],
            )

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            words = term_bytes(text.as_buffer())
            tf, df = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(tf)
            tf.update(words)
            df.update(set(words))
            size += len(tf)
            if size > HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def price(count: Column, total: Column) -> Column:
    """``1 + floor(10^9 * (count + 1) / total)``, exact for totals up to 9 * 10^15."""

    def digit(rest: Column) -> tuple[Column, Column]:
        return F.call_function("div", rest * 1000, total), (rest * 1000) % total

    a, rest = digit(count + 1)
    b, rest = digit(rest)
    c, _ = digit(rest)
    return a * 1_000_000 + b * 1000 + c + 1


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def postings(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Kept terms of every group with their counts, and the groups; both as stored tables.

    The first has ``lang, source, term, count, total`` (the language's occurrences),
    the second ``lang, source, n, v, n_lang``, all groups that occur.
    """
    empty = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    counts = docs.select(*empty).mapInArrow(_count, COUNTS)
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("tf").alias("count"), F.sum("df").alias("df"))
    # a term has a row a source here
    same = Window.partitionBy("lang", "term")
    counts = counts.select(
        *("lang", "source", "term", "count"),
        F.sum("df").over(same).alias("df"),
        F.sum("count").over(same).alias("total"),
        (F.min("source").over(same) == F.col("source")).alias("first"),
    )
    rows = stored(counts.filter(f"term IS NULL OR df >= {int(least_docs)}").drop("df"))
    groups = rows.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("first"))
    whole = Window.partitionBy("lang")  # a row a source
    groups = groups.select("lang", "source", "n", F.sum("first").over(whole).alias("v"), F.sum("n").over(whole).alias("n_lang"))
    return rows.filter("term IS NOT NULL").drop("first"), stored(groups)


def pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of all ordered pairs of sources of a language.

    ``terms`` has ``lang, source, term, count, p, p0``, ``groups`` has ``lang, source, v, p0`` with
    p0 null where the language keeps no term; such pairs have the value 0.
    """
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "q", "q0"))
    none = F.coalesce(excess(p0, q0), F.lit(0))
    constant = groups.join(other, "lang").filter("source <> item").select("lang", "source", "item", (F.col("v") * none).alias("value"))
    # a row a group and count; its salt deals a language over many tasks
    steps = terms.groupBy("lang", "source", "count").agg(F.count("*").alias("n"), F.first("p").alias("p"), F.first("p0").alias("p0"))
    steps = steps.withColumn("salt", F.pmod(F.xxhash64("source", "count"), F.lit(SALTS)).cast("int"))
    dealt = other.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = steps.join(dealt, ["lang", "salt"]).filter("source <> item")
    one_sided = met.select("lang", F.explode(F.array(
        F.struct("source", "item", (F.col("n") * (excess(p, q0) - none)).alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), (F.col("n") * (excess(q0, p) - excess(q0, p0))).alias("value")),
    )).alias("x")).select("lang", "x.*")
    left = terms.select("lang", "term", "source", "p", "p0")
    right = terms.select("lang", "term", F.col("source").alias("item"), q_of("p"), q_of("p0"))
    both = left.join(right, ["lang", "term"]).filter("source < item")

    def corrected(a, a0, b, b0):
        return F.sum(excess(a, b) - excess(a, b0) - excess(a0, b) + excess(a0, b0))

    both = both.groupBy("lang", "source", "item").agg(corrected(p, p0, q, q0).alias("there"), corrected(q, q0, p, p0).alias("back"))
    overlap = both.select("lang", F.explode(F.array(
        F.struct("source", "item", F.col("there").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")),
    )).alias("x")).select("lang", "x.*")
    parts = constant.unionByName(one_sided).unionByName(overlap)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def q_of(name: str) -> Column:
    return F.col(name).alias("q" + name[1:])


def _ranked(rows: DataFrame, limit: int | None = None) -> DataFrame:
    order = [F.col("value").desc(), F.col("item")]
    if limit is not None:  # the best of each part first
        part = Window.partitionBy("lang", "source", "salt").orderBy(*order)
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS))).withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= limit).drop("salt", "rank")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return rows if limit is None else rows.filter(F.col("rank") <= limit)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how sources diverge from each other, and by which terms.

    Part ``pair`` has every other source of the language; part ``term`` the ``top`` terms that
    a group uses more than its language.  Null text, language and source are ''; groups
    whose texts hold no term, or no kept one, take part with counts of 0.  Where a language
    keeps no term, all pairs have the value 0.  Rows that repeat count each time, ties are
    ordered by the item's bytes, other columns are not read, texts of any length are
    counted whole, and an empty table gives no row.
    """
    terms, groups = postings(docs, lang, source, text, least_docs)
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, price(F.lit(0).cast("long"), F.col("n") + F.col("v"))))
    known = terms.join(groups, ["lang", "source"]).withColumn("p", price(F.col("count"), F.col("n") + F.col("v")))
    q = price(F.col("total"), F.col("n_lang") + F.col("v"))
    more = known.withColumn("q", q).filter("p > q").select("lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
    named = [("pair", _ranked(pairs(known, groups))), ("term", _ranked(more, top))]
    out = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for part, rows in named]
    return out[0].unionByName(out[1])


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT n, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT n) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT g.lang, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang) USING (lang)),
s AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
x AS (SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c, CAST(1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (s.n + l.v) AS BIGINT) AS p,
    CAST(1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS BIGINT) AS q
  FROM s JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
y AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(((x.p - z.p) * (x.p - z.p)) // z.p), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source LEFT JOIN x z ON z.lang = b.lang AND z.source = b.source AND z.term = x.term GROUP BY ALL),
t AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM x WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM y
UNION ALL SELECT * FROM (SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM t) WHERE rank <= {TOP_TERMS}
"""
