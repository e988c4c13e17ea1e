"""Encoding, deduplication, near-duplicates, language, quality, licenses."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from lodestone.llm import bpe, exact_dedup, langid, licenses, quality, superminhash
from lodestone.llm import queries as Q

DOC = "doc_id long, text string, lang string, source string, n_chars long"
RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
TEXTS = [
    (1, None), (2, ""), (3, "Hello world's  \t\n x"), (4, "a" * 5000), (5, "　 ab \xa0   z \U0001f600 ñé"), (6, " " * 3000),
    (7, "naïve façade 12345678 $$$ ## <|endoftext|>"), (8, "ab" * 150 + " é" * 3), (9, "\x85\x1c\x1d q\x00\x7f"), (9, "tie"), (None, "no id"), (9, "tie"),
]


def _encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def _expected(text):
    ids = _encoding().encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_equals_the_library(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    want = sorted(((i, *_expected(t)) for i, t in TEXTS), key=str)
    for cache in (bpe.CACHE_WORDS, 3):  # a cache that is emptied all the time changes nothing
        got = bpe.round_trip(df, "text", "doc_id", RANKS, P.PATTERN, cache_words=cache)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    for encode in (bpe.encode, bpe.encode_native):
        got = bpe.digests(encode(df, "text", RANKS, P.PATTERN), RANKS)
        assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()), key=str) == want


def test_bpe_keeps_columns_and_replaces_its_own(spark):
    df = spark.createDataFrame([("a b", 7, 5)], "text string, ids int, n_tokens int")
    got = bpe.encode(df, "text", RANKS, P.PATTERN).first()
    assert got.ids == _encoding().encode_ordinary("a b") and got.n_tokens == 5
    assert bpe.encode(df.limit(0), "text", RANKS, P.PATTERN).count() == 0


def test_bpe_query_over_the_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = Q.op1_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(docs)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == _expected(docs[r.doc_id]) for r in got)


@pytest.mark.parametrize("seed", range(5))
def test_merges_agree(seed):
    rng = random.Random(seed)
    merges = bpe.Merges(RANKS)
    words = ["".join(rng.choice("abcdeé 一") for _ in range(rng.randint(1, 60))).encode() for _ in range(200)]
    want = [_encoding()._encode_single_piece(w) if w not in RANKS else [RANKS[w]] for w in words]
    assert [x.tolist() for x in merges.fold(words)] == want
    assert [bpe.merge_long(w, RANKS) for w in words] == want


def _dedup_brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    by = collections.defaultdict(list)
    for (i, _), n in zip(rows, norm):
        by[n].append(i)
    keep = {n: min((i for i in ids if i is not None), default=None) for n, ids in by.items()}
    return [(i, keep[n], len(by[n]), i == keep[n], hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm)]


def test_exact_dedup(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, " a b"), (4, None), (2, ""), (2, ""), (None, "a b"), (None, "zz"), (8, "x" * 200_000), (7, "x" * 200_000), (6, "A b"), (10, "é  b"), (11, "é b")]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, h int, keep_id string")
    got = exact_dedup.mark(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(_dedup_brute(rows), key=str)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "9", "2", "None", "7", "6", "10"])
    assert exact_dedup.mark(df.limit(0)).count() == 0 and exact_dedup.drop_copies(df.limit(0)).count() == 0


def _near_brute(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k) and root(a) != root(b):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in ids}


def _near_rows(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, i = [(0, None), (1, ""), (2, " \n "), (3, "one two"), (4, "ONE  two"), (5, "one")], 6
    for _ in range(n // 6):
        base = [rng.choice(vocab) for _ in range(rng.randint(5, 200))]
        rows.append((i, " ".join(base)))
        i += 1
        for _ in range(5):  # chains: each copy is edited from the last
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                base[rng.randrange(len(base))] = rng.choice(vocab)
            rows.append((i, "\n".join(base) if rng.random() < 0.3 else " ".join(base).upper()))
            i += 1
    ids = [r[0] for r in rows]
    rng.shuffle(ids)
    return [(j, t) for j, (_, t) in zip(ids, rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_brute_force(spark, seed):
    rows = _near_rows(seed)
    want = _near_brute(rows)
    got = superminhash.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Buckets of several blocks, leaders of several copies: the same result."""
    monkeypatch.setattr(superminhash, "BLOCK", 3)
    monkeypatch.setattr(superminhash, "SALT_ROWS", 2)
    rows = _near_rows(3, 36)
    got = superminhash.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _near_brute(rows)


def _shared_passage(n, seed=9):
    """Texts that share one passage and are below 0.75 in pairs, with a few that are not."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join([*passage, *(f"w{rng.randrange(10**6)}" for _ in range(40))])) for k in range(n)]
    return rows + [(n + k, rows[k * 7][1] + " end") for k in range(5)]


@pytest.mark.parametrize("block", [7, 1000])
def test_documents_of_one_passage(spark, block):
    rows = _shared_passage(150)
    got = superminhash.components(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _near_brute(rows)


def test_similarity_is_a_parameter(spark):
    assert superminhash.least_equal(128, 75) == 66 and superminhash.least_equal(128, 50) == 30 and superminhash.least_equal(128, 1) == 0
    rows = _near_rows(4, 48) + [(1000 + i, t) for i, t in _shared_passage(30)]
    got = superminhash.components(spark.createDataFrame(rows, "doc_id long, text string"), percent=50, places=256, rows=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _near_brute(rows, 50)


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "x " * 50_000)], "doc_id long, text string")
    got = superminhash.components(df.withColumn("rep", F.lit(1)).withColumn("id", F.lit("x"))).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 1, "2", True), ("None", 2, "None", True)]
    assert superminhash.components(df.limit(0)).count() == 0
    assert superminhash.drop_near(df).columns == df.columns


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = x[:800], x[100:]
    same = [(superminhash.signature(np.unique(a ^ np.uint64(s))) == superminhash.signature(np.unique(b ^ np.uint64(s)))).mean() for s in range(20)]
    assert abs(np.mean(same) - 700 / 900) < 0.03
    for n in (1, 2, 5, 127, 128, 129, 5000):
        assert int(superminhash.signature(np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))).max()) < 2**63


@pytest.mark.parametrize("local", [0, 40, 50_000])
def test_components_of_long_chains_and_stars(spark, local):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.v: r.c for r in superminhash.connected(spark.createDataFrame(edges, "a long, b long"), local).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    truth = {r.doc_id: (r.lang, len(r.text or "")) for r in docs.collect()}
    got = [r for r in Q.op7_compression_langid(spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    right = {r.doc_id: r.lang_pred == truth[r.doc_id][0] for r in got}
    # a few labels of the table are wrong on purpose
    assert np.mean([right[r.doc_id] for r in got if truth[r.doc_id][1] >= 200]) > 0.93
    assert np.mean([r.rejected for r in got if right[r.doc_id]]) < 0.02
    # what is rejected is far more often wrong than what is not
    short = [r for r in got if truth[r.doc_id][1] < 200]
    assert np.mean([right[r.doc_id] for r in short if not r.rejected]) > 0.9
    assert sum(r.rejected for r in got) > 0


def test_language_by_hand(spark):
    """The prediction is the least sum of compressed blocks, computed here from the dictionaries."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(langid.sample(docs.filter(~langid.held_out(F.col("doc_id")))))
    for r in langid.predict(docs, model).collect():
        raw = (r.text or "").lower().encode()
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        sizes = {}
        for lang, d in zip(model.languages, model.dictionaries):
            c = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False)
            sizes[lang] = sum(len(c.compress(raw[i : i + langid.BLOCK])) for i in range(0, len(raw), langid.BLOCK))
        first, second = sorted(sizes.values())[:2]
        assert sizes[r.lang_pred] == first and r.score == (second - first) / second
        assert r.rejected == (r.score <= model.margins[langid.length_class(r.text)])


def test_what_is_no_language_is_rejected(spark):
    import base64

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(langid.sample(docs.filter(~langid.held_out(F.col("doc_id")))))
    rng = random.Random(1)
    greek = ["".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω ") for _ in range(n)) for n in [10, 40, 150, 600, 1500, 6000] * 20]
    coded = [base64.b64encode(rng.randbytes(n)).decode() for n in [10, 40, 150, 600, 1500, 6000] * 20]
    assert np.mean([model.classify(t)[2] for t in greek]) > 0.95
    assert np.mean([model.classify(t)[2] for t in coded]) > 0.8


def test_language_edges(spark):
    rows = [(k, "the cat and the dog " * 9, "en") for k in range(20)] + [(k + 20, "der hund und die katze " * 9, "de") for k in range(20)] + [(90, None, "en"), (91, "", None), (92, "123 !?", "de"), (93, "der hund " * 20_000, "de"), (None, "the dog", None)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")).collect()}
    assert len(got) == len(rows)
    assert {got[i].lang_pred for i in (90, 91, 92)} == {"und"} and all(got[i].rejected and got[i].score == 0 for i in (90, 91, 92))
    assert got[93].lang_pred == "de" and got[0].lang_pred == "en" and got[25].lang_pred == "de"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(empty).count() == 0
    assert langid.identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).first().lang_pred == "und"


def _stats_brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(wins)
    hit = {k for i, x in enumerate(wins) if n[x] > 1 for k in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def test_quality_statistics():
    rng = random.Random(4)
    texts = [None, "", " \n", "a", "a b c a b c", "x x x x", "a\na\n\n\nb\na ", "é#|<> é"]
    texts += ["".join(rng.choice(["a", "b", " ", "\n", "#", " c "]) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    assert [quality.statistics(t) for t in texts] == [_stats_brute(t) for t in texts]


def test_quality_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = Q.op8_isolation_forest(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        n, chars, sym, dup, rep = _stats_brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n) and not (r.base_failed and r.kept)
    passing = [r for r in got if not r.base_failed and r.doc_id in labels]
    assert np.mean([r.kept for r in passing if labels[r.doc_id] == 1]) > 0.99
    assert np.mean([r.kept for r in passing if labels[r.doc_id] == 0]) < 0.2
    again = {r.doc_id: r.kept for r in Q.op8_isolation_forest(spark, sf).collect()}
    assert again == {r.doc_id: r.kept for r in got}


def test_forest_by_hand():
    """Paths walked one row and one node at a time, and a threshold found by trying all."""
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0, 1, (300, 4)), rng.normal(6, 0.3, (30, 4))
    stats = np.column_stack([np.full(330, 100), np.vstack([good, bad]) * 20 + 500])
    stats = np.abs(np.round(stats))
    stats[:, 4] %= 51
    label = np.arange(330) < 300
    forest = quality.fit(stats, label)
    x = quality.features(stats)

    def path(tree, row):
        column, value, left, right, length = tree
        k = 0
        while column[k] >= 0:
            k = left[k] if row[column[k]] < value[k] else right[k]
        return length[k]

    depth = 2 * sum(1 / k for k in range(1, 256)) - 2 * 255 / 256  # of an unsuccessful search
    want = [2 ** (-np.mean([path(t, row) for t in forest.trees]) / quality._expected(quality.SUBSAMPLE)) for row in x]
    assert np.allclose(forest.score(x), want) and abs(quality._expected(256) - depth) < 0.01
    scores = forest.score(x)
    ok = [t for t in [*scores, *(scores + 1e-9), 1.0] if (scores[label] > t).mean() <= quality.LOST]
    best = max((scores[~label] > t).mean() - (scores[label] > t).mean() for t in ok)
    assert (scores[~label] > forest.threshold).mean() - (scores[label] > forest.threshold).mean() == best
    # every statistic is split on, none by preference
    counts = np.bincount(np.concatenate([t[0][t[0] >= 0] for t in forest.trees]), minlength=4)
    assert counts.min() > 0.15 * counts.sum()


def test_a_repeated_id_is_learned_once(spark):
    docs = spark.createDataFrame([(1, "a b " * 40), (1, "c " * 80), (2, "d e " * 50)] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (2, None)], "doc_id long, quality int")
    forest = quality.learn(docs, labels)
    again = quality.learn(docs.repartition(5).orderBy(F.rand(3)), labels)
    assert forest.threshold == again.threshold and [t[0].tolist() for t in forest.trees] == [t[0].tolist() for t in again.trees]


def test_the_forest_learns_from_every_label(spark):
    n = 9000  # more than any bound on labelled rows that there was
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["ab", "cdefg", "h", "#", "longer|word"]) + str(rng.randrange(90)) for _ in range(rng.randint(45, 70))) for _ in range(60)]
    docs = spark.createDataFrame([(k, texts[k % 60]) for k in range(n)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 60 < 50)) for k in range(n)], "doc_id long, quality int")
    forest = quality.learn(docs, labels)
    want = quality.fit(np.array([quality.statistics(texts[k % 60]) for k in range(n)]), np.arange(n) % 60 < 50)
    assert forest.threshold == want.threshold and all(np.array_equal(a, b) for s, t in zip(forest.trees, want.trees) for a, b in zip(s, t))


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "a " * 60, 7), (3, "b c d e f " * 30_000, 8)], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    forest = quality.learn(docs, labels)
    got = quality.judge(docs, forest).collect()
    assert sorted((str(r.doc_id), r.n_words, r.kept) for r in got) == [("1", 0, False), ("2", 0, False), ("3", 150_000, False), ("None", 60, False)]
    assert quality.judge(docs.limit(0), forest).count() == 0


def test_licenses(spark):
    filler = " ".join(f"word{k}" for k in range(300))
    rows = [
        (1, f"{filler} Released under the MIT License. {filler}"), (2, filler), (3, None), (4, ""), (5, "Licensed under the Apache License, Version 2.0"),
        (6, f"{filler}\nThis work is licensed under the GNU General Public License, version 3."), (7, "a license under the version of work"), (8, "RELEASED UNDER THE mit license " * 3),
        (9, "This work is licensed under the GNU Public License, version 3"), (None, "Licensed under CC BY-NC 4.0."), (5, "Licensed under the Apache License, Version 2.0"), (11, "license " * 4000),
    ]
    got = sorted((str(r.doc_id), r.license_id) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", "MIT"), ("5", "Apache-2.0"), ("6", "GPL-3.0"), ("8", "MIT"), ("None", "CC-BY-NC-4.0")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert licenses.scan(df.limit(0)).count() == 0 and licenses.scan(df, []).count() == 0


def test_licenses_of_one_window_all_stay(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "We say: Released under the MIT License.\nLicensed under CC BY-NC 4.0. That is all."), (2, f"word {gpl} word"), (3, f"{gpl} {gpl} Licensed under the MIT License."),
        (4, "Released under the MIT License. " * 3), (4, "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0."),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license_id): r.matches for r in got} == {
        (1, "MIT"): 1, (1, "CC-BY-NC-4.0"): 1, (2, "GPL-3.0"): 1, (3, "GPL-3.0"): 2, (3, "MIT"): 1, (4, "MIT"): 3, (4, "CC-BY-4.0"): 1, (4, "CC-BY-SA-4.0"): 1,
    }
    assert all(r.containment == 1.0 for r in got)


def _license_brute(text):
    """Every place of every template's shingles in the whole text, no windows, no MinHash."""
    words = re.findall(licenses.WORDS, (text or "").lower())
    grams = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    hits = []
    for t, (name, body) in enumerate(licenses.TEMPLATES):
        tw = re.findall(licenses.WORDS, body.lower())
        shingles = list(dict.fromkeys(" ".join(tw[i : i + 5]) for i in range(len(tw) - 4)))
        enough = lambda at: 100 * len({k for _, k in at}) >= 75 * len(shingles)  # noqa: E731, B023
        done, at = [], []
        for p, g in enumerate(grams):
            if g in shingles:
                k = shingles.index(g)
                if at and (p - at[0][0] >= 1.5 * len(tw) or (k == at[0][1] and enough(at))):
                    done.append(at)
                    at = []
                at.append((p, k))
        for one in [*done, at]:
            if one and enough(one):
                hits.append((-len(one), -len({k for _, k in one}) / len(shingles), t, one[0][0], name, {p for p, _ in one}))
    kept = []
    for h in sorted(hits, key=lambda h: h[:4]):
        if not any(h[5] & x[5] for x in kept):
            kept.append(h)
    return collections.Counter(h[4] for h in kept)


def test_license_query_against_every_place(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {(r.doc_id, n): k for r in docs for n, k in _license_brute(r.text).items()}
    got = Q.op4_license_scan(spark, sf).collect()
    assert {(r.doc_id, r.license_id): r.matches for r in got} == want and len(got) == len(want)
    plain = {(r.doc_id, n) for r in docs for n, body in licenses.TEMPLATES[:11] if body.lower().rstrip(".") in (r.text or "").lower()}
    assert plain <= set(want)


def test_licenses_against_every_place(spark):
    """Whole texts, notices and statements, cut, edited, repeated and strewn in filler."""
    rng = random.Random(3)
    filler = [f"word{k}" for k in range(50)] + ["software", "license", "copyright", "the", "warranty", "released"]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            body = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                body[rng.randrange(len(body))] = "xx"
            parts += [" ".join(body), " ".join(rng.choices(filler, k=rng.choice([0, 1, 5, 90])))]
        rows.append((i, "\n".join(parts)))
    want = {(i, n): k for i, t in rows for n, k in _license_brute(t).items()}
    got = licenses.scan(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, license_id string, size int")).collect()
    assert {(r.doc_id, r.license_id): r.matches for r in got} == want
    assert {n for _, n in want} >= {"BSD-2-Clause", "BSD-3-Clause", "LGPL-2.1-or-later", "GPL-3.0-or-later", "MIT", "ISC"}


def test_license_texts(spark):
    rows = [(k, f"File header.\n{body}\nThe end of it.") for k, (_, body) in enumerate(licenses.TEMPLATES)] + [(None, "Licensed under the MIT License."), (None, "Licensed under CC BY 4.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in licenses.scan(df.union(df)).collect():
        got[r.doc_id].append((r.license_id, r.matches))
    assert all(got[k] == [(name, 1)] for k, (name, _) in enumerate(licenses.TEMPLATES))
    assert sorted(got[None]) == [("CC-BY-4.0", 1), ("MIT", 1)]
    with pytest.raises(ValueError, match="five|5"):
        licenses.scan(df, [("X", "four words are few")])
