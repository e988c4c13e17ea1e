"""Collocations: frequent phrases of a language that hold together at their weakest cut.

Phrases are counted level by level.  A level broadcasts what the level before found
frequent, and a phrase of k words is emitted only where both of its parts of k - 1 words
are frequent; counts below the limit then fall away.  The broadcast is a bitmap of hashes
of ``BITS`` bits, whatever the data: a false hit costs a row that falls away later and
changes no result.

A worker turns words into numbers, finds the places of a level with array operations on
their hashes, counts equal phrases among a few million words and hands on a row a phrase
and chunk, so a phrase that is everywhere arrives as few rows.

A phrase is cut in two at each of its places; the cut with the lowest ratio of twice the
phrase's count to those of its parts is its score.  A phrase that mostly occurs inside a
longer frequent one is dropped.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import stored

LONGEST = 4
LEAST = 30
#: A phrase goes if a longer one has at least this percentage of its count.
INSIDE = 80
TOP = 2000
#: Bits of the broadcast; Spark's bitmaps have 2^15 bits each.
BITS = 1 << 27
#: Words that a worker counts at once, and rows that it hands on at once; they change no result.
HELD, HANDED = 1_000_000, 50_000
COUNTS = "lang string, phrase string, count long"

_EDGE = b"\xff"  # no byte of UTF-8
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256))
_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text) -> list[bytes]:
    """Words of a text in UTF-8, an edge between pieces and at the end."""
    words = bytes(text).translate(_FOLD).replace(b"\n", b" \xff ").split()
    words.append(_EDGE)
    return words


def _places(lang: str, words: np.ndarray, length: int) -> np.ndarray:
    """The bit of each run of ``length`` word hashes."""
    n = max(len(words) - length + 1, 0)
    mixed = np.full(n, xxhash.xxh64_intdigest(lang.encode()), dtype=np.uint64)
    for i in range(length):
        mixed = (mixed ^ words[i : i + n]) * _MULTIPLY
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(BITS)).astype(np.int64)


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _counted(lang: str, ids: np.ndarray, words: list[bytes], level: int, bits: np.ndarray | None):
    """Phrases of ``level`` words among ``ids`` (0 is an edge), and how often they occur, some at a time."""
    inside = ids > 0
    if len(ids) < level:
        return
    shorter = level - 1
    whole = inside[: len(ids) - shorter + 1].copy()
    for i in range(1, shorter):
        whole &= inside[i : i + len(whole)]
    at = _places(lang, _hashes(words)[ids], shorter)
    whole &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    del at
    starts = np.flatnonzero(whole[:-1] & whole[1:])
    if not len(starts):
        return
    code, most = ids[starts].astype(np.int64), len(words)
    for i in range(1, level):
        if most * len(words) >= 1 << 62:
            seen, code = np.unique(code, return_inverse=True)
            most = len(seen)
        code, most = code * len(words) + ids[starts + i], most * len(words)
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    starts = starts[first]
    del code, first
    for k in range(0, len(starts), HANDED):
        parts = [map(words.__getitem__, ids[starts[k : k + HANDED] + i].tolist()) for i in range(level)]
        yield [b" ".join(p) for p in zip(*parts)], counts[k : k + HANDED]


def _level(level: int, bits, held: int):
    """Counts of phrases of ``level`` words; of the first level all words, and a null phrase for a language's words."""

    def batch_of(lang, phrases, counts):
        n = len(phrases)
        columns = [pa.array([lang] * n, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "count"])

    def singles(chunk):
        for lang, counts in chunk.items():
            del counts[_EDGE]
            yield batch_of(lang, [*counts, None], [*counts.values(), counts.total()])

    def runs(chunk):
        for lang, (numbers, arrays) in chunk.items():
            ids = np.concatenate(arrays)
            arrays.clear()
            for phrases, counts in _counted(lang, ids, list(numbers), level, bits.value):
                yield batch_of(lang, phrases, counts)

    def numbered():
        numbers = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[_EDGE]  # is 0
        return numbers, []

    def count(batches):
        chunk, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_buffer())
                if level == 1:
                    chunk.setdefault(lang, Counter()).update(words)
                else:
                    if lang not in chunk:
                        chunk[lang] = numbered()
                    numbers, arrays = chunk[lang]
                    arrays.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
                size += len(words)
                if size >= held:
                    yield from (singles if level == 1 else runs)(chunk)
                    chunk, size = {}, 0
        yield from (singles if level == 1 else runs)(chunk)

    return count


def _bitmap(level: DataFrame, length: int) -> np.ndarray:
    """Bits of the level's phrases; what comes to the driver has ``BITS`` bits at most."""

    def places(batches):
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            groups: dict[str, list[bytes]] = {}
            for lang, phrase in zip(langs, phrases):
                groups.setdefault(lang, []).extend(phrase.encode().split(b" "))
            for lang, words in groups.items():
                at = _places(lang, _hashes(words), length)[::length]
                yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    found = level.select("lang", "phrase").mapInArrow(places, "at long")
    found = found.groupBy((F.col("at") / 32768).cast("int").alias("nth")).agg(F.bitmap_construct_agg((F.col("at") % 32768)).alias("bits"))
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    for row in found.toLocalIterator():
        bits[row.nth * 4096 : (row.nth + 1) * 4096] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits


def levels(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, held: int = HELD) -> list[DataFrame]:
    """Stored tables ``lang, phrase, count`` of phrases of 1, 2, … words that occur ``least`` times.

    The first also has a row of null phrase for each language: its words.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    context = docs.sparkSession.sparkContext
    found: list[DataFrame] = []
    for k in range(1, longest + 1):
        bits = None
        if k > 1:
            bits = context.broadcast(_bitmap(found[-1].filter("phrase IS NOT NULL"), k - 1))
        counts = rows.mapInArrow(_level(k, bits, held), COUNTS).groupBy("lang", "phrase").agg(F.sum("count").alias("count"))
        found.append(stored(counts.filter(f"phrase IS NULL OR count >= {int(least)}")))
        if bits is not None:
            bits.destroy()
    return found


def ratio(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """``floor(2000000 * a / (l + r))``; the product may pass 64 bits."""
    twice = F.lit(2_000_000).cast("decimal(7,0)") * a.cast("decimal(20,0)")
    return F.call_function("div", twice, (l + r).cast("decimal(20,0)"))


def score(found: list[DataFrame], inside: int = INSIDE) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of phrases of two words and more that no longer one covers."""
    parts = found[0].filter("phrase IS NOT NULL")
    for level in found[1:]:
        parts = parts.unionByName(level)
    phrases = found[1]
    for level in found[2:]:
        phrases = phrases.unionByName(level)
    phrases = phrases.withColumnRenamed("count", "a").withColumn("words", F.split("phrase", " "))
    n = F.size("words")
    joined = lambda start, length: F.concat_ws(" ", F.slice("words", start, length))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: joined(i, size))))
    longer = phrases.filter(n > 2).select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True)))

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), n - 1))).select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, n).alias("tail"))
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("count").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    lowest = F.min(F.struct(ratio(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP, held: int = HELD) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    Null languages are 'und' (and join rows that say so), null and empty texts hold no word; a
    language without phrases has no row, an empty table gives none.  Rows that repeat
    count each time, ties go by count and then by the phrase's bytes, other columns are not
    read, and a text of any length is counted whole.
    """
    found = levels(docs, lang, text, longest, least, held)
    scored = score(found, inside)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = numbered(stored(scored), order, by=["lang"], name="rank").filter(F.col("rank") <= top)
    words = found[0].filter("phrase IS NULL").select("lang", F.col("count").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS ws FROM p, range(1, {LONGEST + 1}) r(k) WHERE len(w) >= k),
f AS (SELECT lang, CAST(k AS INTEGER) AS k, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
s AS (SELECT lang, f, array_to_string(list_slice(ws, i, i + j - 1), ' ') AS phrase FROM f, range(2, {LONGEST}) a(j), range(1, {LONGEST}) b(i) WHERE k > j AND i + j - 1 <= k),
c AS (SELECT f.* FROM f LEFT JOIN (SELECT lang, phrase, max(f) AS longer FROM s GROUP BY ALL) o ON f.lang = o.lang AND f.phrase = o.phrase WHERE k >= 2 AND (longer IS NULL OR 100 * longer < {INSIDE} * f)),
u AS (SELECT c.lang, c.phrase, c.f AS a, x AS cut, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * c.f) // (l.f + r.f) AS BIGINT) AS score
  FROM c, range(1, {LONGEST}) y(x), f l, f r WHERE x < c.k AND l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.ws, 1, x), ' ') AND r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.ws, x + 1, c.k), ' ')),
b AS (SELECT lang, phrase, a, l, r, score FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b JOIN n USING (lang)
QUALIFY rank <= {TOP}
"""
