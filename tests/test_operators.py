"""Operators on small cases against plain Python: numbering, quantiles, regions, draws, rank products, block-gzip."""

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import graph, harmonize, intervals, ontology, order, quantiles, signatures, tables
from lodestone.plans import alleles as allele_plans
from lodestone.sources import bgzf


# ---- places in an order


@pytest.mark.parametrize("parts", ["3", "16"])
def test_numbered(spark, parts):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(50), k) for k in range(3000)] + [("lonely", 1, 5000)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "g string, v int, k int")
        got = {(r.g, r.k): r.position for r in order.numbered(df, [F.desc("v"), "k"], by=["g"]).collect()}
        whole = [r.k for r in sorted(order.numbered(df, ["v", "k"], name="n").collect(), key=lambda r: r.n)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {}
    for g in {r[0] for r in rows}:
        for n, (_, _, k) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[g, k] = n
    assert got == want
    assert whole == [k for _, _, k in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert order.numbered(df.limit(0), ["v"], by=["g"]).count() == 0
    again = order.numbered(df.withColumn("position", F.lit("old")), ["v", "k"])
    assert again.columns == ["g", "v", "k", "position"] and dict(again.dtypes)["position"] == "bigint"


def test_no_task_sees_all_rows(spark):
    df = spark.range(2000).select(F.lit("one").alias("g"), F.col("id").alias("v"))
    plan = order.numbered(df, ["v"], by=["g"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_discard_deletes_the_table_only(spark):
    kept, gone = tables.cut(spark.range(3)), tables.cut(spark.range(4))
    tables.discard(gone, spark.range(5))
    assert kept.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(gone._cut_path).count()


def test_components_leave_one_table(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, 501)]
    sym = spark.createDataFrame(edges + [(b, a) for a, b in edges], "src int, dst int")
    got = {r.node: r.component for r in graph.components(sym, local_edges=3).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


# ---- quantiles


def _interpolated(values, p):
    return float(np.quantile(np.array(values, dtype=float), p))


@pytest.mark.parametrize("accuracy, bins", [(10_000, 4096), (20, 4), (3, 1)])
def test_quantiles(spark, accuracy, bins):
    rng = random.Random(accuracy)
    groups = {
        "even": [rng.random() for _ in range(500)], "skewed": [10 ** rng.uniform(-9, 9) * rng.choice([1, -1]) for _ in range(400)], "one": [3.5], "two": [1.0, 2.0],
        "ties": [rng.choice([0.0, 0.0, 0.0, 1.0]) for _ in range(301)], "same": [7.0] * 50, None: [1.0, -1.0, 4.0], "far": [0.0] * 99 + [1e300],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("nothing", None), ("one", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.5, 0.33, 0.67, 0.0, 1.0]
    got = {r.g: (r.n, r.quantiles) for r in quantiles.quantiles(df, "v", probs, ["g"], accuracy, bins).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g][0] == len(vs)
        assert got[g][1] == pytest.approx([_interpolated(vs, p) for p in probs], rel=1e-12, abs=1e-12), g
    every = quantiles.quantiles(df, "v", [0.5], accuracy=accuracy, bins=bins).first()
    assert every.quantiles == pytest.approx([_interpolated([v for vs in groups.values() for v in vs], 0.5)])
    assert quantiles.quantiles(df.limit(0), "v", [0.5]).count() == 0


# ---- regions


@pytest.mark.parametrize("finest", [4, 4096])
def test_regions_of_every_length(spark, finest):
    rng = random.Random(finest)
    regions = [(f"g{k}", rng.randrange(3), a := rng.randrange(-50, 30_000), a + rng.choice([0, 1, 3, 4, 5, 31, 32, 33, 900, 4096, 40_000, 10**9, 10**14])) for k in range(150)] + [("reversed", 1, 500, 100)]
    points = [(k, rng.randrange(3), rng.choice([rng.randrange(0, 31_000), rng.randrange(0, 10**9)])) for k in range(600)] + [(600, 1, -20)]
    p, r = spark.createDataFrame(points, "id int, contig int, pos long"), spark.createDataFrame(regions, "gene string, contig int, start long, end long")
    got = sorted((x.id, x.gene) for x in intervals.in_regions(p, r, 10, finest).collect())
    want = sorted((i, g) for i, c, x in points for g, d, a, b in regions if c == d and a - 10 <= x <= b + 10)
    assert got == want
    assert intervals.in_regions(p, r.limit(0), 10).count() == 0 and intervals.in_regions(p.limit(0), r, 10).count() == 0


def test_a_long_region_is_few_rows(spark):
    r = spark.createDataFrame([("g", 1, 0, 250_000_000)], "gene string, contig int, start long, end long")
    p = spark.createDataFrame([(1, 1, 5)], "id int, contig int, pos long")
    joined = intervals.in_regions(p, r, 0)
    generated = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1 and "Generate" in generated


@pytest.mark.parametrize("far", [40, 30_000, 10**9])
def test_totals_in_regions(spark, far):
    rng = random.Random(far)
    widths = [0, 1, 2, 3, 4, 5, 15, 16, 17, 63, 900, 4096, 40_000, 10**9, 10**14]
    regions = [(f"g{rng.randrange(120)}", rng.randrange(3), a := rng.randrange(-60, far), a + rng.choice(widths)) for _ in range(200)] + [("reversed", 1, 500, 100), ("open", 1, None, 100)]
    points = [(rng.randrange(900), rng.choice([0, 1, 2, None]), rng.randrange(-50, far)) for _ in range(700)] + [(600, 1, -20), (601, 1, -20), (602, 1, None)]
    p, r = spark.createDataFrame(points, "id int, contig int, pos long"), spark.createDataFrame(regions, "gene string, contig int, start long, end long")
    want = {}
    for g, d, a, b in regions:
        want.setdefault(g, []).extend(i for i, c, x in points if None not in (a, x) and c == d and a - 3 <= x <= b + 3)
    assert {x.gene: (x.n_points, x.first_id) for x in intervals.totals_in_regions(p, r, 3).collect()} == {g: (len(v), min(v)) for g, v in want.items() if v}
    assert intervals.totals_in_regions(p, r.limit(0), 3).count() == 0 and intervals.totals_in_regions(p.limit(0), r, 3).count() == 0


def test_long_regions_do_not_multiply_points(spark):
    p = spark.range(20_000).select("id", F.lit(1).alias("contig"), F.col("id").alias("pos"))
    r = spark.range(20_000).select(F.col("id").cast("string").alias("gene"), F.lit(1).alias("contig"), F.lit(0).alias("start"), F.lit(10**9).alias("end"))  # 4 * 10^8 pairs
    got = intervals.totals_in_regions(p, r, 0)
    assert got.filter("n_points = 20000 AND first_id = 0").count() == 20_000


def test_bins_of_regions_are_not_broadcast(spark):
    p = spark.range(3000).select("id", F.lit(1).alias("contig"), F.col("id").alias("pos"))
    r = spark.range(400).select(F.col("id").cast("string").alias("gene"), F.lit(1).alias("contig"), F.col("id").alias("start"), (F.col("id") + 1000).alias("end"))  # few bytes by Spark's estimate
    got = intervals.totals_in_regions(p, r, 5)
    assert {(int(x.gene), x.n_points, x.first_id) for x in got.collect()} == {(k, k + 1006 - max(0, k - 5), max(0, k - 5)) for k in range(400)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


# ---- draws


def test_draws_without_replacement_are_subsets_of_equal_chance(spark):
    pool = spark.createDataFrame([(f"t{k}",) for k in range(5)], "term string")
    drawn = collections.defaultdict(list)
    for r in ontology.random_queries(pool, 3, 4000, 9).collect():
        drawn[r.perm].append(r.term)
    assert len(drawn) == 4000 and all(len(set(x)) == len(x) == 3 for x in drawn.values())
    counts = collections.Counter(tuple(sorted(x)) for x in drawn.values())
    assert len(counts) == 10 and all(330 < n < 470 for n in counts.values())
    few = ontology.random_queries(pool.limit(2), 3, 10, 9).groupBy("perm").agg(F.countDistinct("term").alias("n")).collect()
    assert {r.n for r in few} == {2} and len(few) == 10
    assert ontology.random_queries(pool.limit(0), 3, 4, 9).count() == 0


def test_digits_name_every_subset(spark):
    digits = [list(d) for d in itertools.product(range(4), range(3), range(2))]
    df = spark.createDataFrame([(d,) for d in digits], "d array<bigint>").select(ontology.without_replacement(F.col("d")).alias("x"))
    counts = collections.Counter(tuple(r.x) for r in df.collect())
    assert counts == {s: 6 for s in itertools.combinations(range(4), 3)}


# ---- rank products


@pytest.mark.parametrize("tile", [1, 3, 256])
def test_spearman_by_tiles(spark, tile):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "a", "b"]), [float(rng.randrange(6)) for _ in range(9)]) for k in range(23)] + [(99, "a", [1.0] * 9), (100, "lonely", [1.0, 2.0]), (101, "a", [1.0, 3.0]), (102, "a", [2.0, 1.0])]
    df = spark.createDataFrame(rows, "sig long, grp string, z array<double>")
    got = {(r.a, r.b): r.rho for r in signatures.spearman(df, tile).collect()}

    def ranks(z):
        return np.array([sum(y < x for y in z) + (sum(y == x for y in z) - 1) / 2 for x in z])

    want = {}
    for (a, g, x), (b, h, y) in itertools.combinations(rows, 2):
        if g == h and len(x) == len(y):
            u, v = ranks(x) - ranks(x).mean(), ranks(y) - ranks(y).mean()
            s = np.sqrt((u @ u) * (v @ v))
            want[a, b] = float(u @ v / s) if s else None
    assert set(got) == set(want)
    for k, rho in want.items():
        assert got[k] is None if rho is None else got[k] == pytest.approx(rho, abs=1e-12)
    assert signatures.spearman(df.limit(0)).count() == 0


def test_tiles_grow_with_their_group(spark):
    rng = random.Random(4)
    rows = [(k, k % 2, [float(rng.randrange(9)) for _ in range(7)]) for k in range(60)] + [(60, 0, None), (61, 0, []), (62, 0, [1.0, float("nan"), 3.0, 1.0, 2.0, 5.0, 4.0])]
    df = spark.createDataFrame(rows, "sig long, grp int, z array<double>")
    got = {(r.a, r.b): r.rho for r in signatures.spearman(df, 2, 3).collect()}
    assert got == {(r.a, r.b): r.rho if r.rho is None else pytest.approx(r.rho, abs=1e-12) for r in signatures.spearman(df, 256).collect()}
    assert len(got) == 30 * 29 // 2 * 2 + 30 and all((rho is None) == (62 in pair) for pair, rho in got.items())
    numbers = df.filter("sig < 60").selectExpr("grp", "7 AS size", "CAST(sig DIV 2 + 1 AS BIGINT) AS nth", "sig", "z AS r")
    assert {r["count"] for r in signatures._dealt(numbers, 2, 3).groupBy("sig").count().collect()} == {3}


@pytest.mark.parametrize("together", [1, 3, 10_000])
def test_a_walk_sorts_its_moves_once(spark, together, monkeypatch):
    from lodestone.operators import graph

    rng = random.Random(5)
    pairs = {("hub", f"n{k}"): rng.randrange(1, 9) for k in range(12)} | {(f"n{k}", f"n{k + 1}"): rng.randrange(1, 9) for k in range(11)}
    sym = graph.both_ways(graph.build_edges(spark.createDataFrame([(a, b, s) for (a, b), s in pairs.items()], "a string, b string, score int"), 0))
    plans, cut = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut(df))[1])
    got = {r.node: r.score for r in graph.random_walk(sym, spark.createDataFrame([("n0",)], "node string"), 0.5, 6, together=together).collect()}
    near: dict = {}
    for (a, b), s in pairs.items():
        near.setdefault(a, {})[b] = s
        near.setdefault(b, {})[a] = s
    score = {x: float(x == "n0") for x in near}
    for _ in range(6):
        score = {x: 0.5 * sum(score[y] * w / sum(near[y].values()) for y, w in near[x].items()) + 0.5 * (x == "n0") for x in near}
    assert got == {x: pytest.approx(v, abs=1e-12) for x, v in score.items()}
    assert any("InMemoryRelation" in p and "Sort [src#" in p.split("InMemoryRelation", 1)[1] for p in plans)


def test_a_module_lays_its_edges_down_once(spark, sf_dir, monkeypatch):
    from lodestone.plans import graphs

    laid, cut = [], graphs.ops.cut
    monkeypatch.setattr(graphs.ops, "cut", lambda df: (laid.append(df.columns), cut(df))[1])
    assert graphs.module_topk(spark, sf_dir).columns == ["node", "is_seed", "rank"]
    assert laid.count(["src", "dst", "score"]) == 1


# ---- block-gzip text


def _lines(n, seed=1):
    rng = random.Random(seed)
    rows = sorted((rng.choice(["1", "2", "X"]), rng.randrange(0, 900_000), k) for k in range(n)) + [("Z", 0, n)]
    return [(c, p, f"{c}\t{p}\trs{k}\t{rng.choice(['A', 'ACGT' * rng.randrange(1, 30)])}\tT\t.\tPASS\tNOTE={'x' * rng.randrange(200)}") for c, p, k in rows]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    folder = f"{tmp_path_factory.mktemp('bgzf')}/v"
    lines = _lines(6000)
    bgzf.register(spark)
    made = bgzf.write_sorted(spark.createDataFrame(lines, "contig string, pos long, value string"), folder, 2).collect()
    assert sum(r.lines for r in made) == len(lines)
    return folder, lines


@pytest.mark.parametrize("split", [700, 40_000, 1 << 26])
def test_splits_read_every_line_once(spark, archive, split):
    folder, lines = archive
    got = spark.read.format("bgzf").option("split", split).load(folder)
    assert sorted((r.contig, r.pos, r.value) for r in got.collect()) == sorted(lines)


@pytest.mark.parametrize("split", [700, 1 << 26])
@pytest.mark.parametrize("regions", ["1:1000-1200", "X", "2:1-500000,2:400000-600000,1:5-16385", "7", "X:890000-", "1,2,X", "Z,2:0-90000"])
def test_regions_equal_a_full_scan(spark, archive, regions, split):
    folder, lines = archive
    wanted = bgzf.regions_of(regions)
    got = spark.read.format("bgzf").option("split", split).option("regions", regions).load(folder)
    assert sorted((r.contig, r.pos, r.value) for r in got.collect()) == sorted(x for x in lines if any(c == x[0] and a < x[1] <= b for c, a, b in wanted))


def test_filters_choose_the_blocks(spark, archive):
    folder, lines = archive
    df = spark.read.format("bgzf").load(folder)
    got = df.filter("contig = '2' AND pos BETWEEN 300000 AND 310000")
    assert sorted(r.value for r in got.collect()) == sorted(v for c, p, v in lines if c == "2" and 300000 <= p <= 310000)
    assert df.filter("contig IN ('1', 'X') AND pos < 1000").count() == sum(c in "1X" and p < 1000 for c, p, _ in lines)
    reader = bgzf.Reader({"path": folder})
    reader.regions = [("2", 299_999, 310_000)]
    read = 0
    for part in reader.partitions():
        fs, name = bgzf.filesystem(part.path)
        with fs.open_input_file(name) as f:
            src = bgzf.Blocks(f, f.size())
            list(bgzf.part_lines(src, part))
            read += sum(src.length(b) for b in [part.start])
    whole = sum(i.size for i in bgzf.filesystem(folder)[0].get_file_info(__import__("pyarrow").fs.FileSelector(folder)) if i.path.endswith(".gz"))
    assert len(reader.partitions()) <= 2 and read < whole / 5


def test_damaged_blocks_are_errors(spark, archive, tmp_path):
    folder, _ = archive
    import glob

    raw = bytearray(open(sorted(glob.glob(f"{folder}/*.gz"))[0], "rb").read())
    raw[len(raw) // 2] ^= 0xFF
    (tmp_path / "bad.vcf.gz").write_bytes(raw)
    with pytest.raises(Exception, match="damaged|no block|invalid|cut off|decompressing"):
        spark.read.format("bgzf").load(str(tmp_path)).count()


def test_a_file_that_bgzip_would_write(spark, tmp_path):
    """Header lines, a last line without its end, an index of one contig."""
    text = b"##fileformat=VCFv4.2\n#CHROM\tPOS\n" + b"".join(b"chr1\t%d\t.\tA\tT\n" % p for p in range(1, 4000)) + b"chr1\t9000\t.\tA\tT"
    raw = b"".join(bgzf._block(text[i : i + 1000]) for i in range(0, len(text), 1000)) + bgzf.END
    (tmp_path / "a.vcf.gz").write_bytes(raw)
    for split in (50, 1 << 20):
        got = spark.read.format("bgzf").option("split", split).load(f"{tmp_path}/a.vcf.gz")
        assert sorted(r.pos for r in got.collect()) == [*range(1, 4000), 9000]
    import gzip

    assert gzip.decompress(raw) == text


# ---- records


def test_records_of_any_shape(spark):
    import json

    from lodestone.sources import records

    whole = {
        "id": 7, "pmid": "11", "pmcid": "PMC1", "doi": "10.1/ABC", "title": "  A title ", "journalInfo": {"journal": {"title": "J"}}, "pubYear": 2001, "source": "MED",
        "pubTypeList": {"pubType": ["Letter", "letter", "Retraction of Publication", "", None]}, "meshHeadingList": {"meshHeading": [{"descriptorName": "Mice"}, {"other": 1}, "no object", {"descriptorName": "Animals"}]},
        "commentCorrectionList": {"commentCorrection": {"type": "Erratum in"}}, "abstractText": "text",
    }
    texts = [json.dumps(whole), json.dumps({"id": "8", "source": "PPR", "doi": ""}), json.dumps({"doi": "10.2/X", "journalInfo": "none", "pubTypeList": []}), "{}", '{"id": ', "[1]", '"text"', "null", None, ""]
    rows = records.parsed(spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "n int, text string, title string"), "text")
    got = {r.n: r for r in records.normalised(rows).collect()}
    assert [got[k].bad for k in range(len(texts))] == [None] * 4 + ["malformed", "not_an_object", "not_an_object", "not_an_object", None, "malformed"]
    r = got[0]
    assert (r.key, r.id, r.pmcid, r.doi, r.title, r.journal, r.year, r.types, r.terms) == ("11", "7", "PMC1", "10.1/abc", "A title", "J", "2001", ["letter", "retraction of publication"], ["animals", "mice"])
    assert r.retracted and r.corrected and not r.concern and r.abstract == "text"
    assert [got[k].key for k in range(1, 10)] == ["PPR:8", "10.2/x", "", "", "", "", "", "", ""]
    assert records.quarantined(rows).count() == 5


def test_answers_are_read_page_by_page_and_capped(spark):
    import json

    from lodestone.sources import records

    def page(*ids):
        return {"resultList": {"result": [{"id": i, "source": "MED"} for i in ids]}}

    answers = [("q", json.dumps({"pages": [page("a", "b"), page("b", "c", "d")]})), ("single", json.dumps(page("z"))), ("one", json.dumps({"resultList": {"result": {"id": "y", "source": "S"}}})), ("bad", "{"), ("none", "{}")]
    found, bad = records.results(spark.createDataFrame(answers, "q string, value string"), query="q")
    assert sorted((r.q, r.page, r.nth, r.key) for r in found.collect()) == [("one", 0, 0, "S:y"), ("q", 0, 0, "MED:a"), ("q", 0, 1, "MED:b"), ("q", 1, 0, "MED:b"), ("q", 1, 1, "MED:c"), ("q", 1, 2, "MED:d"), ("single", 0, 0, "MED:z")]
    assert [r.q for r in bad.collect()] == ["bad"]
    kept = records.first_of_each(found, ["page", "nth"], 3, ["q"])
    assert sorted((r.q, r.page, r.nth) for r in kept.collect()) == [("one", 0, 0), ("q", 0, 0), ("q", 0, 1), ("q", 1, 1), ("single", 0, 0)]


def test_capped(spark):
    from lodestone.operators import records as ops

    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", "b"]), rng.randrange(1000), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, k int")
    want = sorted(x for g in "ab" for x in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:20])
    assert sorted(map(tuple, ops.capped(df, ["g"], [F.desc("v"), "k"], 20, 4).collect())) == want
    assert sorted(map(tuple, ops.capped(df, [], ["k"], 3).collect())) == sorted(rows, key=lambda r: r[2])[:3] or ops.capped(df, [], ["k"], 3).count() == 3


# ---- nulls and walks


@pytest.mark.parametrize("block", [2, 7, 256])
def test_matched_null_in_blocks(spark, block):
    import hashlib

    from lodestone.operators import nulls

    rng = random.Random(8)
    nodes = [f"n{k:03d}" for k in range(60)]
    bins = {n: k // 25 for k, n in enumerate(nodes)}
    dist = {n: rng.randrange(9) for n in nodes if rng.random() < 0.8}
    targets = [(f"k{rng.randrange(5)}", n) for n in rng.sample(nodes, 40)]
    got = nulls.matched_null(
        spark.createDataFrame(targets, "key string, node string"), spark.createDataFrame(list(bins.items()), "node string, bin int"), spark.createDataFrame(list(dist.items()), "node string, distance long"), 6, 3, block
    )
    pool = collections.defaultdict(list)
    for n in sorted(dist):
        pool[bins[n]].append(dist[n])
    want = collections.defaultdict(list)
    for key, n in targets:
        if n in dist:
            held = pool[bins[n]]
            for p in range(6):
                want[key, p].append(held[int(hashlib.md5(f"3|{key}|{n}|{p}".encode()).hexdigest()[:8], 16) % len(held)])
    assert {(r.key, r.perm): r.d for r in got.collect()} == {k: pytest.approx(sum(v) / len(v)) for k, v in want.items()}


@pytest.mark.parametrize("local", [0, 50_000])
@pytest.mark.parametrize("most", [None, 2])
def test_distances_near_and_far(spark, local, most):
    rng = random.Random(3)
    edges = {(rng.randrange(60), rng.randrange(60)) for _ in range(50)} | {(100, 101)}
    sym = sorted({e for a, b in edges if a != b for e in ((a, b), (b, a))})
    got = graph.bfs_distances(spark.createDataFrame(sym, "src int, dst int"), spark.createDataFrame([(1,), (2,), (1,)], "node int"), most, local)
    seen, front, hops = {1: 0, 2: 0}, [1, 2], 0
    while front and (most is None or hops < most):
        hops += 1
        front = sorted({b for a, b in sym if a in front and b not in seen})
        seen.update(dict.fromkeys(front, hops))
    assert {r.node: r.distance for r in got.collect()} == seen


# ---- plug-ins


def test_policies():
    from lodestone.plans import policies

    assert [n for n, _ in policies.policy("mane_select_tiered")] == ["primary", "secondary"]
    for name, why in (("canon", "refused"), ("all_transcripts", "refused"), ("other", "no policy")):
        with pytest.raises(ValueError, match=why):
            policies.policy(name)
    with pytest.raises(ValueError, match="refused"):
        policies.register("canon", (("primary", ()),))
    with pytest.raises(ValueError, match="in this order"):
        policies.register("mine", (("secondary", ()),))
    policies.register("mine", (("primary", ("-x",)),))
    try:
        assert policies.policy("mine") == (("primary", ("-x",)),)
        with pytest.raises(ValueError, match="exists"):
            policies.register("mine", (("primary", ()),))
    finally:
        del policies.POLICIES["mine"]


def test_rules_are_a_list(spark):
    from lodestone.operators import triage

    labels = spark.createDataFrame([(1, {"warnings": "w"}, ["Prescription"], []), (2, None, ["Discontinued"], [])], "id int, sections map<string,string>, statuses array<string>, classes array<string>")
    own = triage.Rule("named", True, lambda: (F.when(F.col("id") == 1, "pass"), F.lit("by_number")))
    got = {r.id: r for r in triage.verdicts(labels, [triage.RULES[2], own]).collect()}
    assert [v.rule for v in got[1].verdicts] == ["currently_marketed", "named"]
    assert (got[1].survives, got[1].excluded_by, got[2].survives, got[2].excluded_by) == (True, None, False, "currently_marketed")
    assert [r.excluded_by for r in triage.verdicts(labels, [own]).orderBy("id").collect()] == [None, "named"]
    assert all(r.survives for r in triage.verdicts(labels, []).collect())
    with pytest.raises(ValueError, match="one name"):
        triage.verdicts(labels, [own, own])


# ---- annotations, formerly literal queries


def test_best_annotations(spark):
    ann = [
        ("v1", "AC=1;ANN=T|stop_gained|HIGH|GENE1|id|transcript|TX1|protein_coding|5/10|c.1A>T|p.Arg550Ter|,T|missense_variant|MODERATE|GENE1|id|transcript|TX2|protein_coding|2/3|c.2A>T|p.Gly12Val|"),
        ("v2", "ANN=T|splice_donor_variant&intron_variant|HIGH|GENE1|id|transcript|TX3|retained_intron|1/2|c.3+1G>T||"),
        ("v3", "DB;ANN=C|missense_variant|MODERATE|GENE2|id|transcript|TX4|protein_coding|3/3|c.4A>C|p.Leu7Pro|,C|synonymous_variant|LOW|GENE2|id|transcript|TX5|protein_coding|1/4|c.5A>C|p.Ala9=|"),
        ("v4", "ANN=G|short|HIGH"),
        ("v5", "AF=0.5"),
    ]
    got = allele_plans.best_annotations(spark.createDataFrame(ann, "id string, info string"))
    rows = sorted((r.id, r.gene, r.transcript, r.effect_class, r.protein_pos, r.last_exon) for r in got.collect())
    assert rows == [("v1", "GENE1", "TX1", "lof", 550, False), ("v2", "GENE1", "TX3", "other", None, False), ("v3", "GENE2", "TX4", "protein_altering", 7, True)]


def test_annotations_are_compared_within_a_row(spark):
    from lodestone.functions import alleles as fn

    one = "T|{}|{}|{}|id|transcript|{}|protein_coding|1/3|c.1A>T|p.Gly7Val|"
    rows = [
        ("v1", "ANN=" + ",".join([one.format("missense_variant", "LOW", "B", "TX9"), one.format("stop_gained", "LOW", "A", "TX2"), one.format("stop_gained", "HIGH", "A", "TX3"), one.format("missense_variant", "odd", "B", "TX1")])),
        ("v1", "ANN=" + one.format("stop_gained", "HIGH", "A", "TX1")),
        ("v2", "ANN=x;ANN=" + one.format("intron_variant", "LOW", "", "TX1") + ";XANN=y"),
        ("v3", None),
    ]
    df = spark.createDataFrame(rows, "id string, info string")
    got = allele_plans.best_annotations(df)
    assert sorted((r.id, r.gene, r.transcript) for r in got.collect()) == [("v1", "A", "TX1"), ("v1", "B", "TX9"), ("v2", "", "TX1")]
    once = allele_plans.best_annotations(df, repeats=False)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.gene, r.transcript) for r in once.collect()) == [("v1", "A", "TX1"), ("v1", "A", "TX3"), ("v1", "B", "TX9"), ("v2", "", "TX1")]
    values = df.select(fn.info_value(F.col("info"), "ANN").alias("x"), fn.info_map(F.col("info"))["ANN"].alias("y")).collect()
    assert all(r.x == r.y for r in values)


# ---- what is counted before it is joined


def test_identifiers_are_merged_before_they_meet(spark):
    rng = random.Random(8)
    records = [(rng.choice(["a", "b", "c", "d", None]), rng.choice(["x", "y", "z", None]), rng.choice("123")) for _ in range(400)] + [("e", None, None)]
    candidates = [(k, [rng.choice(["a", "b", "c", "e", "none"]) for _ in range(3)]) for k in range(40)] + [(40, None), (41, []), (3, ["a"])]
    c, r = spark.createDataFrame(candidates, "key int, ids array<string>"), spark.createDataFrame(records, "identifier string, section string, status string")
    df = harmonize.merge_identifiers(c, r)
    want = {}
    for key, ids in candidates:
        hit = [x for i in sorted(set(ids or [])) for x in records if x[0] == i]
        want.setdefault(key, []).extend(hit)
    want = {k: (" ".join(sorted({x[1] for x in v if x[1]})), "|".join(sorted({x[2] for x in v if x[2]})), len(v)) for k, v in want.items() if v}
    assert {x.key: (x.text, x.statuses, x.n_records) for x in df.collect()} == want
    assert "Aggregate" in df._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]


def test_best_matches_stay_with_their_entity(spark):
    rng = random.Random(3)
    ann = {(rng.randrange(3000), f"t{rng.randrange(6)}") for _ in range(6000)}
    sims = [(f"t{a}", f"t{b}", rng.random()) for a in range(6) for b in range(6) if (a + b) % 5]
    asked = [(p, f"t{rng.randrange(6)}") for p in range(4)] + [(0, "t9")]
    kinds = ["perm int, term string", "entity int, term string", "q string, term string, sim double"]
    asked_at, ann_at, sims_at = (tables.cut(spark.createDataFrame(rows, kind)) for rows, kind in zip([asked, sorted(ann), sims], kinds))
    got = ontology.best_match(asked_at, ann_at, sims_at, ["perm"])
    want = {}
    for p in range(4):
        terms = [t for n, t in asked if n == p]
        for e in {x for x, _ in ann}:
            best = [max((s for q, t, s in sims if q == one and (e, t) in ann), default=None) for one in terms]
            if any(b is not None for b in best):
                want[e, p] = pytest.approx(sum(b or 0 for b in best) / len(terms))
    assert {(r.entity, r.perm): r.score for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "hashpartitioning(entity" in x and ", q#" in x]


def test_routes_to_targets(spark):
    rng = random.Random(4)
    hits, ic = {e: rng.random() for e in range(0, 20, 2)}, {f"t{k}": rng.random() for k in range(5)}
    ann = sorted({(rng.randrange(15), f"t{rng.randrange(5)}") for _ in range(40)})
    first, second = ([(rng.randrange(22), rng.randrange(30)) for _ in range(120)] for _ in range(2))
    link = "entity int, target int"
    got = ontology.routes(
        spark.createDataFrame(list(hits.items()), "entity int, score double"), spark.createDataFrame(ann, "entity int, term string"),
        spark.createDataFrame(list(ic.items()), "term string, ic double"), spark.createDataFrame(first, link), spark.createDataFrame(second, link),
    )
    want = {}
    for e, x in first:
        if e in hits:
            want.setdefault(x, set()).add((hits[e], e))
    for e, x in second:
        for n, t in ann:
            if n == e:
                want.setdefault(x, set()).add((ic[t], t))
    assert {r.target: (r.s, r.support) for r in got.collect()} == {x: (max(s for s, _ in v), len(v)) for x, v in want.items()}
