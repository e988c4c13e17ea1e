"""Near-duplicate detection by SuperMinHash, banding, exact verification and union-find.

A document's set holds hashes of its distinct word shingles.  SuperMinHash gives
each element a random permutation of the signature's places with one rising rank
each, so that places are filled without replacement; values of step j lie in
[j, j + 1), which lets a document stop at the first step that can improve no
place.  The signature is cut into bands; equal bands make a bucket.

Candidates are kept linear in the number of rows.  Documents with equal sets form
a class at once.  In every bucket the class of smallest id is the leader and all
others are verified against it only.  A bucket whose classes are thereby of one
component needs no more.  In the others, members outside the bucket's largest
component meet all members in tiles of two parts of bounded size, first by their
signatures alone.  Those with a partner of another component whose signature
agrees in enough places meet again with their texts; pairs are verified on their
full sets, and only links leave a tile.  A bucket of m such members makes m rows
of a few hundred bytes for every 250 of them, whatever their texts.

At 0.75 and 32 bands of 4, two documents share no band with probability 5e-6;
``least_equal`` passes over a similar pair with probability 1e-9.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import LOCAL_EDGES, solved
from .common import cut, discard, stored

WIDTH = 5
PLACES = 128
ROWS = 4
#: Members a part of a tile holds, and pairs of one leader that share a copy of its text.
BLOCK = 250
SALT_ROWS = 1000

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A-Z is lower-cased; words end at ASCII white space.  A text of fewer words
    than ``width`` has its whole sequence as the only shingle; one without words
    has none.
    """
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], dtype=np.uint64)
    n, k = max(1, len(h) - width + 1), min(width, len(h))
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s += _mix(h[j : j + n] + np.uint64(j)) * _MULT[j % 5]
    return np.unique(_mix(s + np.uint64(k)))


def signature(elements: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash of a set: per place (step << 32 | draw) at its least."""
    m, n = places, len(elements)
    h = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    p = None
    rows = np.arange(n)
    for j in range(m):
        v = _mix(elements + np.uint64((int(_GOLD) * (j + 1)) & 0xFFFFFFFFFFFFFFFF))
        draw = (v >> np.uint64(32)) | np.uint64(j << 32)
        k = (j + (((v & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
        if j == 0:
            at = k
        else:
            if p is None:  # the first step's swap, made up for
                p = np.tile(np.arange(m, dtype=np.int16), (n, 1))
                p[rows, first], p[:, 0] = 0, first
            at = p[rows, k]
            p[rows, k], p[:, j] = p[:, j], at
        first = k if j == 0 else first
        np.minimum.at(h, at, draw)
        if int(h.max()) >> 32 <= j:  # later steps only draw more
            break
    return h


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash for each band; the band's number takes part."""
    parts = sig.reshape(-1, rows)
    s = np.zeros(len(parts), np.uint64)
    for j in range(rows):
        s = _mix(s * _GOLD + parts[:, j])
    return _mix(s + np.arange(1, len(parts) + 1, dtype=np.uint64) * _MULT[1]).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, in whole numbers."""
    if not len(a) or not len(b):
        return False
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def least_equal(places: int, percent: int) -> int:
    """Equal places (of 8 bits) below which ``percent`` is out of reach: six deviations under the mean."""
    share = percent / 100
    return max(0, math.floor(places * share - 6 * math.sqrt(places * share * (1 - share))))


def sketch(docs: DataFrame, text: str, id_col: str, width: int, places: int, rows: int) -> DataFrame:
    """``id, n_shingles, d1, d2, bands, sig`` for each row; no bands without words."""

    @F.pandas_udf("n_shingles long, d1 long, d2 long, bands array<long>, sig binary")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        import xxhash

        out = []
        for t in texts:
            s = shingles(t, width)
            if not len(s):
                out.append((0, None, None, None, None))
                continue
            d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
            g = signature(s, places)
            out.append((len(s), int(d[0]), int(d[1]), bands(g, rows), _mix(g).astype(np.uint8).tobytes()))
        frame = pd.DataFrame(out, columns=["n_shingles", "d1", "d2", "bands", "sig"])
        return frame.astype({"n_shingles": "int64", "d1": "Int64", "d2": "Int64"})

    return docs.select(F.col(id_col).alias("id"), sketched(F.col(text)).alias("s")).select("id", "s.*")


def connected(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``v, c`` for every vertex of ``edges`` (a, b): c is its component's least vertex.

    Rounds of contraction: every vertex points to its least neighbour, pointers
    are followed to their roots, edges are moved to the roots.  A round at least
    halves the vertices that still have edges; once at most ``local_edges`` edges are left, one
    task joins the rest.  Nothing comes to the driver but counts, and a round's tables go
    with it.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct())
    labels = None
    while left := edges.count():
        if left <= local_edges:
            parents = jumped = stored(solved(edges).select(F.col("a").alias("v"), F.col("p").alias("c")))
        else:
            both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select(F.col("b"), F.col("a")))
            parents = jumped = stored(both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("c")))
            while True:  # follow pointers; chains halve each time
                up = parents.select(F.col("v").alias("c"), F.col("c").alias("cc"))
                before, jumped = jumped, stored(parents.join(up, "c", "left").select("v", F.coalesce("cc", "c").alias("n"), "c"))
                discard(before)
                parents = jumped.select("v", F.col("n").alias("c"))
                if jumped.filter("n <> c").isEmpty():
                    break
        up = parents.select(F.col("v").alias("c"), F.col("c").alias("cc"))
        old, labels = labels, stored(parents if labels is None else labels.join(up, "c", "left").select("v", F.coalesce("cc", "c").alias("c")))
        if left <= local_edges:
            discard(jumped, edges, *([] if old is None else [old]))
            return labels
        last = edges
        for end in ("a", "b"):
            up = parents.select(F.col("v").alias(end), F.col("c").alias("cc"))
            edges = edges.join(up, end).withColumn(end, F.col("cc")).drop("cc")
        edges = stored(edges.filter("a <> b").distinct())
        discard(jumped, last, *([] if old is None else [old]))
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
    return labels


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (leader a, member b, bucket size n) that are similar on their full sets.

    A leader's text is laid out once per ``SALT_ROWS`` members of a bucket, so a
    leader of any number of members is spread evenly.
    """
    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    salted = pairs.select("a", "b", salts.alias("salts")).withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    copies = (
        salted.select("a", "salts").distinct().join(texts, F.col("a") == F.col("id"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select("a", "salts", "salt", F.col("t").alias("ta"))
    )
    placed = salted.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b").join(copies, ["a", "salts", "salt"])

    def check(it):
        for pdf in it:
            last, s = None, None
            good = []
            for ta, tb in zip(pdf["ta"], pdf["tb"]):
                if ta is not last:
                    last, s = ta, shingles(ta, width)
                good.append(similar(s, shingles(tb, width), percent))
            yield pdf.loc[good, ["a", "b"]]

    return placed.select("a", "b", "ta", "tb").mapInPandas(check, "a long, b long")


def _among(width: int, percent: int, verify: bool):
    """Of a tile's members those that may be linked, or their links.

    Both look at pairs of different components and parts, or of one part that is
    settled here, that share this tile's band as their first and whose signatures
    agree in enough places.
    """

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        key = int(pdf["key"].iloc[0])
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
        band = np.stack(pdf["bands"].to_numpy())
        ids, comps, part, settled = (pdf[c].to_numpy() for c in ("id", "c", "part", "settled"))
        least = least_equal(sig.shape[1], percent)
        parent = {c: c for c in comps.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        sets, links, some = {}, [], np.zeros(len(pdf), bool)

        def set_of(i):
            if i not in sets:
                sets[i] = shingles(pdf["t"].iloc[i], width)
            return sets[i]

        for i in range(len(pdf) - 1):
            near = np.flatnonzero((comps[i + 1 :] != comps[i]) & (settled[i] | (part[i + 1 :] != part[i]))) + i + 1
            near = near[(sig[near] == sig[i]).sum(1) >= least]
            if not len(near):
                continue
            equal = band[near] == band[i]
            near = near[band[i][equal.argmax(1)] == key]  # a pair belongs to the first band it shares
            if not verify:
                some[near] = True
                some[i] |= len(near) > 0
                continue
            for j in near:
                a, b = root(int(comps[i])), root(int(comps[j]))
                if a != b and similar(set_of(i), set_of(j), percent):
                    links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    parent[a] = b
        if verify:
            return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
        return pdf.loc[some, ["key", "x", "y", "id", "c", "part", "settled"]]

    return found


def _rest(members: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame, width: int, percent: int, block: int) -> DataFrame:
    """Links among those of a bucket that its leader was not enough for.

    The leader has met everyone.  The others are dealt to parts, those of the
    bucket's largest component to parts of their own, the last ones.  A tile
    (x, y) holds two parts, the first never of that component, whose members need
    not meet.  Pairs inside a part are settled in the first tile that has it.
    """
    others = members.filter("id <> a").select("key", "id")
    labelled = cut(others.join(comps.withColumnRenamed("v", "id"), "id", "left").withColumn("c", F.coalesce("c", "id")))
    per = labelled.groupBy("key", "c").agg(F.count("*").alias("n"))
    sums = per.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("major"), F.sum("n").alias("total"), F.max("n").alias("most"))

    def parts(n):
        return F.ceil(n / block).cast("int")

    open_ = sums.filter("most < total").select("key", "major", parts(F.col("total") - F.col("most")).alias("nv"), parts(F.col("most")).alias("nm"))
    h = F.xxhash64("id")
    part = F.when(F.col("c") != F.col("major"), F.pmod(h, F.col("nv"))).otherwise(F.col("nv") + F.pmod(h, F.col("nm"))).cast("int")
    rows = labelled.join(open_, "key").withColumn("part", part)
    most = F.when(F.col("part") < F.col("nv"), F.col("nv") + F.col("nm")).otherwise(F.col("nv"))
    met = F.filter(F.sequence(F.lit(0), most - 1), lambda q: q != F.col("part"))
    rows = rows.select("key", "id", "c", "nv", "part", F.explode(met).alias("q"))
    rows = rows.withColumn("x", F.least("part", "q")).withColumn("y", F.greatest("part", "q"))
    settled = (F.col("part") < F.col("nv")) & (F.col("x") == 0) & (F.col("y") == F.greatest("part", F.lit(1)))
    sketched = rows.select("key", "x", "y", "id", "c", "part", settled.alias("settled")).join(reps, "id")
    near = sketched.groupBy("key", "x", "y").applyInPandas(
        _among(width, percent, False), "key long, x int, y int, id long, c long, part int, settled boolean"
    )
    full = stored(near).join(reps, "id").join(texts, "id")
    return full.groupBy("key", "x", "y").applyInPandas(_among(width, percent, True), "a long, b long").distinct()


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` with the components that ``links`` connect made one."""
    ends = links.select(F.col("a").alias("v")).union(links.select("b")).distinct()
    base = stored(comps.union(ends.join(comps, "v", "left_anti").select("v", F.col("v").alias("c"))))
    a, b = (base.select(F.col("v").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    moved = connected(links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return base.join(moved.select(F.col("v").alias("c"), F.col("c").alias("cc")), "c", "left").select("v", F.coalesce("cc", "c").alias("c"))


def components(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    width: int = WIDTH,
    percent: int = 75,
    places: int = PLACES,
    rows: int = ROWS,
    block: int | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    Null or empty texts have no shingles and are linked with nothing; rows of a
    null id are linked with nothing either.  Rows that share an id share its
    component.  Texts of equal sets are one class before any candidate is made.
    Other columns are not read; an empty table gives an empty result.
    """
    sk = cut(sketch(docs, text, id_col, width, places, rows))
    # a key that no aggregate is dealt by: the join deals both sides anew and may split a hot class
    full = sk.filter("n_shingles > 0 AND id IS NOT NULL").withColumn("set", F.concat_ws(":", "d1", "d2"))
    classes = full.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    tagged = full.join(classes.select(F.concat_ws(":", "d1", "d2").alias("set"), "rep"), "set")
    reps = cut(tagged.filter("id = rep").dropDuplicates(["id", "d1", "d2"]).select("id", "bands", "sig"))
    members = reps.select("id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    members = cut(members.join(buckets, "key"))
    pairs = cut(members.filter("id <> a").groupBy("a", F.col("id").alias("b")).agg(F.max("n").alias("n")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).filter("id IS NOT NULL")
    links = cut(_verified(pairs, texts, width, percent))
    # ids repeated over different texts are one vertex already; their classes join here
    twice = tagged.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")).join(
        reps.select(F.col("id").alias("b")), "b", "left_semi"
    ).select("a", "b")
    links = links.union(twice)
    comps = connected(links)
    more = stored(_rest(members, comps, reps, texts, width, percent, block or BLOCK))
    if not more.isEmpty():
        comps = _joined(comps, more)
    final = tagged.select(F.col("id"), "rep").distinct().join(comps.withColumnRenamed("v", "rep"), "rep", "left")
    final = final.groupBy("id").agg(F.min(F.coalesce("c", "rep")).alias("c"))
    out = sk.select("id", "n_shingles").join(final, "id", "left")
    return out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.coalesce("c", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("c", "id"), F.lit(True)).alias("kept"),
    )


def drop_near(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each component, all columns kept; rows of null id stay."""
    lost = components(docs, text, id_col, **options).filter("NOT kept").select(F.col("doc_id").alias("__lost")).distinct()
    return docs.join(lost, docs[id_col] == lost["__lost"], "left_anti")


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM d
), u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM p WHERE 100 * k >= 75 * (na + nb - k) UNION SELECT b, a FROM p WHERE 100 * k >= 75 * (na + nb - k)),
r AS (SELECT doc_id AS v, doc_id AS c FROM s UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.c)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m AS component_id, doc_id = m AS kept FROM s JOIN (SELECT v, min(c) AS m FROM r GROUP BY v) ON v = doc_id
"""
