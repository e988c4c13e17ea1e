"""Toxicity, divergence of sources, collocations."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import collocations, divergence, toxicity
from lodestone.llm import queries as Q
from lodestone.llm.common import term_bytes

DOC = "doc_id long, text string, lang string, source string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- divergence


def _terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def _audit_brute(docs, top=200, least=3):
    docs = [(t or "", la or "", s or "") for _, t, la, s in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(_terms(t), s) for t, la, s in docs if la == lang]
        df = collections.Counter(w for ts, _ in own for w in set(ts))
        kept = [w for w, n in df.items() if n >= least]
        count = {s: collections.Counter(w for ts, x in own if x == s for w in ts if df[w] >= least) for s in {s for _, s in own}}
        all_of = sum(count.values(), collections.Counter())

        def p(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for s in count:
            pairs = [(o, sum((p(count[s], w) - p(count[o], w)) ** 2 // p(count[o], w) for w in kept)) for o in count if o != s]
            terms = [(w, (p(count[s], w) - p(all_of, w)) ** 2 // p(all_of, w)) for w in kept if count[s][w] and p(count[s], w) > p(all_of, w)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out, key=str)


def _mixed_docs(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "été", "d'accord", "x1y", "𝔘ni", "zz", "a_b", "İ"] + [f"w{chr(97 + k)}{chr(97 + k % 5)}" for k in range(26)]
    docs = []
    for k in range(n):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 40)))
        docs.append((k, text, rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s2", "é", None])))
    return docs + [(n, None, "en", "s9"), (n + 1, "", "xx", "s1"), (n + 2, "lonely words here", "yy", "s1"), (n + 3, "others", "yy", "s2"), (0, "the the", "en", "s1"), (None, "the " * 3000, "en", "s2")]


@pytest.mark.parametrize("held", [5, 300_000])
def test_divergence_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    docs = _mixed_docs(held)
    df = spark.createDataFrame([(*d, 7, "clash") for d in docs], DOC + ", term int, p string")
    assert _rows(divergence.audit(df)) == _audit_brute(docs)
    assert _rows(divergence.audit(df, top=2)) == _audit_brute(docs, top=2)


def test_divergence_edges(spark):
    empty = spark.createDataFrame([], DOC)
    assert divergence.audit(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None), (2, "", "", "b"), (3, "once", "", "c")], DOC)
    assert _rows(divergence.audit(nothing)) == _audit_brute([(1, None, None, None), (2, "", "", "b"), (3, "once", "", "c")])


@pytest.mark.parametrize("count, total", [(0, 1), (0, 3), (7, 8), (10**13 - 1, 9 * 10**15), (9 * 10**15 - 2, 9 * 10**15 - 1), (123456789012, 987654321098)])
def test_prices_are_exact(spark, count, total):
    row = spark.range(1).select(divergence.price(F.lit(count).cast("long"), F.lit(total).cast("long")).alias("p")).first()
    assert row.p == 1 + 10**9 * (count + 1) // total


# ---- collocations


def _mine_brute(docs, least=30, top=2000, longest=4):
    counts, words = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, _ in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(ws)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least}
        longer = collections.Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        found = []
        for p, a in often.items():
            if len(p) > 1 and 100 * longer[p] < 80 * a:
                score, _, left, right = min((2000000 * a // (often[p[:k]] + often[p[k:]]), k, often[p[:k]], often[p[k:]]) for k in range(1, len(p)))
                found.append((score, a, " ".join(p), left, right))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k + 1, p, a, left, right, words[lang], s) for k, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out, key=str)


def _phrase_docs(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["new", "York", "city", "hall", "été", "a\x1fb", "x\x00y", "ﬁ", "of", "the", "$$$", "\xa0", "𝔘"]
    docs = []
    for k in range(n):
        words = []
        while len(words) < rng.randrange(1, 60):
            words += rng.choice([["New", "york", "City", "hall"], ["new", "york"], [rng.choice(vocabulary)], [rng.choice(vocabulary), ". "], ["of", "the\n"], [f"u{k}"]])
        docs.append((k, rng.choice([" ", "\t", "  "]).join(words), rng.choice(["en", "en", None, "und", "fr"]), "s"))
    return docs + [(n, None, "en", "s"), (n + 1, "", "empty", "s"), (n + 2, "only a few", "de", "s"), (0, "new york new york new york", "en", "s"), (None, "hall the " * 5000, "en", "s")]


@pytest.mark.parametrize("held, bits", [(7, 1 << 27), (2_000_000, 1 << 27), (1000, 1 << 15)])
def test_collocations_against_brute_force(spark, monkeypatch, held, bits):
    """Neither chunks nor a crowded bitmap change a row."""
    monkeypatch.setattr(collocations, "BITS", bits)
    docs = _phrase_docs(held)
    df = spark.createDataFrame([(*d, 1, "clash") for d in docs], DOC + ", phrase int, count string")
    assert _rows(collocations.mine(df, held=held)) == _mine_brute(docs)
    assert _rows(collocations.mine(df, least=3, top=9)) == _mine_brute(docs, least=3, top=9)


def test_collocations_of_nothing(spark):
    assert collocations.mine(spark.createDataFrame([], DOC)).count() == 0
    assert collocations.mine(spark.createDataFrame([(1, None, None, None), (2, "...", "en", None)], DOC)).count() == 0


def test_crowded_bitmaps_only_let_more_through():
    words = [b"\xff", b"a", b"b", b"c"]
    ids = np.array([1, 2, 3, 0, 1, 2, 0, 3])
    full = np.full(collocations.BITS // 8, 255, dtype=np.uint8)

    def counted(level, bits):
        return {p: n for some in collocations._counted("en", ids, words, level, bits) for p, n in zip(*some)}

    assert counted(2, full) == {b"a b": 2, b"b c": 1} and counted(3, full) == {b"a b c": 1}
    assert counted(2, np.zeros_like(full)) == {}


def test_ratios_pass_64_bits(spark):
    a, left, right = 9 * 10**15, 9 * 10**15 + 5, 9 * 10**15 + 11
    row = spark.range(1).select(collocations.ratio(*(F.lit(x).cast("long") for x in (a, left, right))).alias("s")).first()
    assert row.s == 2000000 * a // (left + right)


# ---- toxicity


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.Machine({}, 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    active = np.array([0, 3, 4, 8])
    pairs = sum(m.v[i] @ m.v[j] for k, i in enumerate(active) for j in active[k + 1 :])
    assert m.margin(active) == pytest.approx(0.3 + m.w[active].sum() + pairs)
    assert m.margin(np.zeros(0, dtype=int)) == 0.3


def test_pairs_that_no_additive_weights_tell():
    """Either word alone is clean, both together are toxic, and so is neither."""
    rng = random.Random(3)
    lists, toxic = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        lists.append([0] * a + [1] * b + sorted(rng.sample(range(2, 30), 5)))
        toxic.append(int(a == b))
    w0, w, v = toxicity.train(lists, np.array(toxic), np.ones(3000), 30)
    m = toxicity.Machine({}, w0, w, v)
    right = [(m.margin(np.array(x)) >= 0) == bool(y) for x, y in zip(lists, toxic)]
    assert sum(right) / len(right) > 0.97


def test_insult_with_a_mention_of_a_group(spark):
    rng = random.Random(5)
    filler = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    docs, labels = [], []
    for k in range(1500):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        words = rng.choices(filler, k=rng.randrange(5, 60)) + ["Filthy"] * insult + ["martians"] * group
        rng.shuffle(words)
        docs.append((k, " ".join(words)))
        labels.append((k, int(insult and group)))
    df, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df, toxicity.learn(df, known)).collect()}
    out = [k for k in range(1500) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got[k].predicted == labels[k][1] for k in out) / len(out) > 0.97
    again = {r.doc_id: r for r in toxicity.score(df, toxicity.learn(df.orderBy(F.desc("doc_id")), known.repartition(3))).collect()}
    assert got == again


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    got = Q.op11_factorization_toxicity(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = got.filter("held_out").join(labels.filter("toxic IS NOT NULL"), "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.collect())
    clean, toxic = [r for r in rows if not r.toxic], [r for r in rows if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.5 * len(toxic)


def test_toxicity_edges(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "ÿ " * 40_000, 7), (None, "x", 8), (1, None, 5)], "doc_id long, text string, score int")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(df, toxicity.learn(df, none)).collect()
    assert len(got) == 5 and all(r.score < 0.5 and r.predicted == 0 for r in got)
    assert toxicity.score(df.limit(0), toxicity.learn(df.limit(0), none)).count() == 0
    one = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(df, toxicity.learn(df, one)).collect()} == {0}


def test_terms_of_a_text():
    assert term_bytes("Ab-cÉ9d_İx".encode()) == ["ab".encode(), "cÉ".encode(), b"d", "İx".encode()]
    assert term_bytes(None) == [] and term_bytes(b"") == [] and term_bytes(b"12 \x7f[`{@") == []
