"""Window and burden queries: line items stand for sites of a position-ordered scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import burden
from ..operators import windows as ops
from .registry import query, table

WIDTH, MIN_DEPTH, MIN_HET, THRESHOLD, MIN_RUN = 2000, 40, 5, 1.5, 2

SITES = """sites AS (
  SELECT l_suppkey % 24 AS contig, l_orderkey AS pos, l_quantity AS ref, 51 - l_quantity + l_linenumber AS alt,
         l_returnflag = 'R' AS het, l_linestatus = 'F' AS passing FROM lineitem)"""
WINDOWS = f"""{SITES}, kept AS (
  SELECT *, alt / (ref + alt) AS baf, ref + alt AS dp FROM sites WHERE passing AND ref + alt >= {MIN_DEPTH}
), win AS (
  SELECT contig, CAST(floor(pos / {WIDTH}) AS BIGINT) * {WIDTH} AS "start", CAST(floor(pos / {WIDTH}) AS BIGINT) * {WIDTH} + {WIDTH} AS "end",
         count(*) AS n_sites, count(*) FILTER (WHERE het) AS n_het,
         avg(abs(baf - 0.5)) FILTER (WHERE het) AS mean_abs_dev, median(CAST(dp AS DOUBLE)) FILTER (WHERE het) AS median_dp
  FROM kept GROUP BY ALL)"""
BASELINE = f"""{WINDOWS}, dev AS (SELECT mean_abs_dev d FROM win WHERE n_het >= {MIN_HET}),
c AS (SELECT median(d) AS centre, count(*) AS n FROM dev),
base AS (SELECT CASE WHEN any_value(n) < 2 THEN 0 ELSE any_value(centre) END AS baseline,
                CASE WHEN any_value(n) < 2 THEN 0 ELSE median(abs(d - centre)) * 1.4826 END AS sd, count(*) AS n_windows FROM dev, c)"""
SCORED = f"""{BASELINE}, scored AS (
  SELECT win.*, CASE WHEN n_het >= {MIN_HET} AND sd > 0 THEN (mean_abs_dev - baseline) / sd END AS z, baseline FROM win, base
), judged AS (
  SELECT *, CASE WHEN n_het < {MIN_HET} OR mean_abs_dev IS NULL THEN 'insufficient_sites' WHEN z IS NULL THEN 'unscored'
                 WHEN z >= {THRESHOLD} THEN 'imbalanced' ELSE 'baseline' END AS verdict FROM scored)"""


def _sites(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_suppkey") % 24).alias("contig"),
        F.col("l_orderkey").alias("pos"),
        F.col("l_quantity").alias("ref"),
        (51 - F.col("l_quantity") + F.col("l_linenumber")).alias("alt"),
        (F.col("l_returnflag") == "R").alias("het"),
        (F.col("l_linestatus") == "F").alias("passing"),
    )


def _windows(spark, sf_dir):
    return ops.position_windows(_sites(spark, sf_dir), WIDTH, MIN_DEPTH)


def _scored(spark, sf_dir):
    w = _windows(spark, sf_dir)
    base = ops.robust_baseline(w, MIN_HET)
    return ops.score_windows(w, base, MIN_HET, THRESHOLD), base


@query(f"WITH {WINDOWS} SELECT contig, \"start\", \"end\", n_sites, n_het, round(mean_abs_dev, 6) AS mean_abs_dev, median_dp FROM win")
def site_windows(spark, sf_dir):
    return _windows(spark, sf_dir).withColumn("mean_abs_dev", F.round("mean_abs_dev", 6))


@query(f"WITH {BASELINE} SELECT round(baseline, 6) AS baseline, round(sd, 6) AS sd, n_windows FROM base")
def robust_baseline(spark, sf_dir):
    b = ops.robust_baseline(_windows(spark, sf_dir), MIN_HET)
    return b.select(F.round("baseline", 6).alias("baseline"), F.round("sd", 6).alias("sd"), "n_windows")


@query(f"WITH {SCORED} SELECT contig, \"start\", n_het, round(z, 6) AS z, verdict FROM judged")
def window_scores(spark, sf_dir):
    return _scored(spark, sf_dir)[0].select("contig", "start", "n_het", F.round("z", 6).alias("z"), "verdict")


@query(f"""WITH {SCORED}, inf AS (
  SELECT *, verdict = 'imbalanced' AS flag, row_number() OVER (PARTITION BY contig ORDER BY "start")
         - row_number() OVER (PARTITION BY contig, verdict = 'imbalanced' ORDER BY "start") AS island
  FROM judged WHERE verdict <> 'insufficient_sites'
), run AS (SELECT contig, max(n) AS r FROM (SELECT contig, island, count(*) n FROM inf WHERE flag GROUP BY ALL) GROUP BY ALL)
SELECT j.contig, count(*) AS n_windows, count(*) FILTER (WHERE verdict <> 'insufficient_sites') AS n_informative,
       count(*) FILTER (WHERE verdict = 'imbalanced') AS n_flagged, coalesce(any_value(r), 0) AS longest_run,
       round(median(mean_abs_dev) FILTER (WHERE verdict <> 'insufficient_sites'), 6) AS median_abs_dev,
       round(greatest(0, (median(mean_abs_dev) FILTER (WHERE verdict <> 'insufficient_sites')) - any_value(baseline)), 6) AS excess,
       CASE WHEN count(*) FILTER (WHERE verdict <> 'insufficient_sites') = 0 THEN 'insufficient_sites'
            WHEN coalesce(any_value(r), 0) < {MIN_RUN} THEN 'baseline' ELSE 'imbalanced' END AS verdict
FROM judged j LEFT JOIN run USING (contig) GROUP BY j.contig""")
def contig_rollup(spark, sf_dir):
    scored, base = _scored(spark, sf_dir)
    out = ops.contig_rollup(scored, base, MIN_RUN)
    return out.withColumn("median_abs_dev", F.round("median_abs_dev", 6)).withColumn("excess", F.round("excess", 6))


@query(f"""WITH {SITES}, f AS (SELECT contig, count(*) AS n_sites, count(*) FILTER (WHERE het) / count(*) AS h FROM sites WHERE passing AND ref + alt >= {MIN_DEPTH} GROUP BY contig)
SELECT contig, n_sites, round(h, 6) AS het_fraction, CASE WHEN n_sites < 200 THEN 'undetermined' WHEN h < 0.2 THEN 'XY' ELSE 'XX' END AS sex FROM f""")
def het_fraction(spark, sf_dir):
    f = ops.het_fractions(_sites(spark, sf_dir), MIN_DEPTH)
    return f.select("contig", "n_sites", F.round("het_fraction", 6).alias("het_fraction"), burden.infer_sex(F.col("het_fraction"), F.col("n_sites")).alias("sex"))


@query(f"""WITH {WINDOWS} SELECT contig, "start", round(d, 6) AS excess,
  round(CASE WHEN d <= 0 THEN 0 WHEN d <= 1.0 / 6 + 1e-12 THEN least(1, 4 * d / (1 - 2 * d)) END, 6) AS gain,
  round(CASE WHEN d <= 0 THEN 0 WHEN d <= 0.5 + 1e-12 THEN least(1, 4 * d / (1 + 2 * d)) END, 6) AS loss
FROM (SELECT contig, "start", mean_abs_dev - 0.1 AS d FROM win WHERE mean_abs_dev IS NOT NULL)""")
def mosaic_fraction(spark, sf_dir):
    w = _windows(spark, sf_dir).filter("mean_abs_dev IS NOT NULL").withColumn("d", F.col("mean_abs_dev") - 0.1)
    return w.select(
        "contig", "start", F.round("d", 6).alias("excess"),
        F.round(burden.mosaic_fraction(F.col("d"), True), 6).alias("gain"),
        F.round(burden.mosaic_fraction(F.col("d"), False), 6).alias("loss"),
    )


_ERF = "2 / sqrt(pi()) * exp(-{z} * {z}) * list_sum(list_transform(range(0, 121), lambda n: CASE WHEN {z} = 0 THEN 0 ELSE exp((2 * n + 1) * ln({z}) + n * ln(2) - (lgamma(2 * n + 2) - lgamma(n + 1) - n * ln(2))) END))"


def _fold(d: str) -> str:
    z = f"(({d}) / (s * sqrt(2)))"
    return f"(s * sqrt(2 / pi()) * exp(-{z} * {z}) + ({d}) * {_ERF.format(z=z)})"


@query(f"""WITH {WINDOWS}, st AS (SELECT contig, "start", mean_abs_dev AS m, 0.5 / sqrt(median_dp) AS s FROM win WHERE median_dp IS NOT NULL)
SELECT contig, "start", round(s, 6) AS sigma, round({_fold('0.1')}, 5) AS folded,
  round(CASE WHEN m <= s * sqrt(2 / pi()) THEN 0 WHEN m >= {_fold('0.4999')} THEN NULL ELSE
    (list_reduce(list_prepend([0.0, 0.4999], list_transform(range(1, 31), lambda k: [k * 1.0, 0.0])),
       lambda b, k: CASE WHEN {_fold('(b[1] + b[2]) / 2')} < m THEN [(b[1] + b[2]) / 2, b[2]] ELSE [b[1], (b[1] + b[2]) / 2] END)[1]
     + list_reduce(list_prepend([0.0, 0.4999], list_transform(range(1, 31), lambda k: [k * 1.0, 0.0])),
       lambda b, k: CASE WHEN {_fold('(b[1] + b[2]) / 2')} < m THEN [(b[1] + b[2]) / 2, b[2]] ELSE [b[1], (b[1] + b[2]) / 2] END)[2]) / 2 END, 5) AS shift
FROM st""")
def noise_deconvolution(spark, sf_dir):
    w = _windows(spark, sf_dir).filter("median_dp IS NOT NULL").withColumn("sigma", burden.sigma_at_depth(F.col("median_dp")))
    return w.select(
        "contig", "start", F.round("sigma", 6).alias("sigma"),
        F.round(burden.folded_mean(F.lit(0.1), F.col("sigma")), 5).alias("folded"),
        F.round(burden.deconvolve_shift(F.col("mean_abs_dev"), F.col("sigma")), 5).alias("shift"),
    )


_SITES_TEXT = """concat(CAST(l_suppkey % 24 AS {t}), '\t', CAST(l_orderkey AS {t}), '\trs', CAST(l_partkey AS {t}), '\tA\tT\t.\t', CASE WHEN l_linestatus = 'F' THEN 'PASS' ELSE 'q10' END, '\tDP=', CAST(l_linenumber AS {t}))"""
_REGION = ("3", 1000, 30000, "17")


@query(f"""SELECT CAST(l_suppkey % 24 AS VARCHAR) AS contig, count(*) AS n_sites, count(*) FILTER (WHERE l_linestatus = 'F') AS n_pass, CAST(sum(l_linenumber) AS BIGINT) AS depth, min(l_orderkey) AS first_pos FROM lineitem
WHERE l_suppkey % 24 = 17 OR (l_suppkey % 24 = 3 AND l_orderkey BETWEEN 1000 AND 30000) GROUP BY 1""")
def region_scan(spark, sf_dir):
    """Sites written as block-gzipped, indexed text and read back: of two contigs, one in part, through the index."""
    import uuid

    from ..operators.tables import shared_folder
    from ..sources import bgzf, readers

    li = table(spark, sf_dir, "lineitem")
    lines = li.select((F.col("l_suppkey") % 24).cast("string").alias("contig"), F.col("l_orderkey").alias("pos"), F.expr(_SITES_TEXT.format(t="STRING")).alias("value"))
    folder = f"{shared_folder(li).rstrip('/')}/sites-{uuid.uuid4().hex}"
    bgzf.write_sorted(lines, folder).collect()  # a row a file
    sites = readers.read_block_vcf(spark, folder, "{}:{}-{},{}".format(*_REGION))
    passing = (F.size("filter") == 0) | F.array_contains("filter", "PASS")
    return sites.groupBy("contig").agg(F.count("*").alias("n_sites"), F.count_if(passing).alias("n_pass"), F.sum(F.col("info")["DP"].cast("bigint")).alias("depth"), F.min("pos").alias("first_pos"))
