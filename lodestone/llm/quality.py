"""Quality rules with an isolation forest over their statistics.

Rules count words, characters, symbols, repeated lines and repeated windows of
a text.  Trees split the statistics at random places of random statistics, and all
good labelled rows are counted in their leaves; rows that few splits set apart are
anomalous.  Bad rows are many and alike and would shelter each other in the
trees; they set the box that splits are drawn from.  The threshold on the mean
path length is calibrated on all labelled rows: it is the one that separates good
from bad best among those that keep nearly all good rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, stored

#: Trees; rows that stand for a tree's in its path lengths; levels of splits.
TREES = 200
SUBSAMPLE = 256
NODES = 2**9 - 1  # of a tree whose paths have at most 8 splits
AXES = ["f0", "f1", "f2", "f3"]
#: Share of good labelled rows that the threshold may lose.
LOST = 0.002
FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

_word = re.compile(WORD)
_symbol = re.compile(r"[#*$%&|<>]")


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = _word.findall(text)
    lines = [x for x in text.split("\n") if _word.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        upto = 0  # words before this place are counted
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return len(words), sum(map(len, words)), len(_symbol.findall(text)), len(lines) - len(set(lines)), repeated


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def features(stats: np.ndarray) -> np.ndarray:
    """Shares that do not depend on a text's length; rows of ``statistics``."""
    s = np.asarray(stats, dtype=float).reshape(-1, 5)
    n = np.maximum(s[:, 0], 1)
    # counts stand against a few words more, so a single hit in a short text is no anomaly
    return np.column_stack([s[:, 1] / n, np.log1p(100 * s[:, 2] / (n + 20)), s[:, 3] / (n / 20 + 5), s[:, 4] / (n + 20)])


@dataclass
class Forest:
    """Trees as arrays: split column (-1 in leaves), split value, children, path length."""

    trees: list
    threshold: float = math.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly in (0, 1): 2 to the minus mean path length over its expectation."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for tree in self.trees:
            total += tree[4][_ends(tree, x)]
        return 2.0 ** (-total / len(self.trees) / float(_expected(SUBSAMPLE)))


def _ends(tree: tuple, x: np.ndarray) -> np.ndarray:
    """The node of ``tree`` that each row of ``x`` ends in."""
    column, value, left, right, _ = tree
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = column[at] >= 0
        if not inner.any():
            return at
        go = x[np.arange(len(x)), np.maximum(column[at], 0)] < value[at]
        at = np.where(inner, np.where(go, left[at], right[at]), at)


def _expected(n) -> np.ndarray:
    """Mean depth of an unsuccessful search in a tree of n rows; between whole numbers too."""
    n = np.asarray(n, dtype=float)
    many = 2 * (np.log(np.maximum(n, 2) - 1 + 1e-300) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 2)
    return np.where(n <= 1, 0.0, np.where(n > 2, np.maximum(many, 1.0), n - 1))


def drawn(low: np.ndarray, high: np.ndarray, seed: int) -> Forest:
    """Whole trees of random splits of the box ``low`` to ``high``, in heap order; ``weighed`` ends their paths.

    The box may be wider than the good rows: what lies where none does ends in an
    empty leaf near the root.
    """
    rng = np.random.default_rng(seed)
    nodes = np.arange(NODES)
    trees = []
    for _ in range(TREES):
        column, value = np.full(NODES, -1), np.zeros(NODES)
        boxes = {0: (np.array(low, dtype=float), np.array(high, dtype=float))}
        for k in range(NODES // 2):
            lo, hi = boxes.pop(k, (np.zeros(1), np.zeros(1)))
            wide = np.flatnonzero(hi > lo)
            if len(wide):
                c = int(rng.choice(wide))
                column[k], value[k] = c, float(rng.uniform(lo[c], hi[c]))
                inner, outer = hi.copy(), lo.copy()
                inner[c], outer[c] = value[k], value[k]
                boxes[2 * k + 1], boxes[2 * k + 2] = (lo, inner), (outer, hi)
        trees.append((column, value, 2 * nodes + 1, 2 * nodes + 2, np.zeros(NODES)))
    return Forest(trees)


def counted(forest: Forest, x: np.ndarray) -> np.ndarray:
    """How many rows end in each node, a line a tree."""
    return np.array([np.bincount(_ends(tree, x), minlength=NODES) for tree in forest.trees])


def weighed(forest: Forest, counts: np.ndarray, seen: int) -> Forest:
    """``forest`` with the path lengths that ``counts`` of all ``seen`` good rows give.

    A node's share of the rows stands for as many of ``SUBSAMPLE``: what a tree of that many rows, chosen at
    random, has there in the mean.  A node of at most one ends its paths.
    """
    held = counts.astype(float)
    for k in reversed(range(NODES // 2)):
        held[:, k] += held[:, 2 * k + 1] + held[:, 2 * k + 2]
    held *= min(SUBSAMPLE, seen) / seen
    depth = np.floor(np.log2(np.arange(NODES) + 1))
    length = depth + _expected(held)
    return Forest([(np.where(n > 1, t[0], -1), *t[1:4], at) for t, n, at in zip(forest.trees, held, length)])


def fit(stats: np.ndarray, good: np.ndarray, seed: int = 5) -> Forest:
    """What ``learn`` finds, of arrays: the forest of the good rows' statistics, its threshold calibrated on all labels.

    Without good rows nothing is anomalous.  The threshold lies above all but a
    share ``LOST`` of the good rows that pass the base rules; of equally good ones
    it is the highest.
    """
    stats, good = np.asarray(stats, dtype=float).reshape(-1, 5), np.asarray(good, dtype=bool)
    passing = ~base_failed(stats[:, 0], stats[:, 4])
    x, good = features(stats[passing]), good[passing]
    if not good.any():
        return Forest([])
    forest = drawn(x.min(0), x.max(0), seed)
    forest = weighed(forest, counted(forest, x[good]), int(good.sum()))
    scores = forest.score(x)
    ups = np.unique(scores)
    limits = np.append((ups[:-1] + ups[1:]) / 2, ups[-1] + 0.01)
    lost = np.array([(scores[good] > t).mean() for t in limits])
    caught = np.array([(scores[~good] > t).mean() if (~good).any() else 0.0 for t in limits])
    allowed = lost <= LOST
    gain = np.where(allowed, caught - lost, -1.0)
    best = int(len(gain) - 1 - np.argmax(gain[::-1]))  # of equal gains the most lenient
    forest.threshold = float(limits[best])
    return forest


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five statistics of column ``text``; null counts as no words."""

    @F.pandas_udf(FIELDS)
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=[f.split()[0] for f in FIELDS.split(", ")], dtype="int64")

    names = {f.split()[0] for f in FIELDS.split(", ")}
    return docs.withColumn("__q", measure(F.col(text))).select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], "__q.*")


def _threshold(scored: DataFrame) -> float:
    """The limit that parts (score, good) best among those that lose at most a share ``LOST`` of the good; of equal ones the highest."""
    each = scored.groupBy("score").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    laid = stored(each.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id()))
    sums = laid.groupBy("part").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = sums.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in "gb"])
    totals = sums.agg(F.sum("g").alias("gs"), F.sum("b").alias("bs"))
    above = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    over = {c: F.col(f"{c}0") + F.coalesce(F.sum(c).over(above), F.lit(0)) for c in "gb"}
    lost, caught = F.col("go") / F.col("gs"), F.coalesce(F.try_divide(F.col("bo"), F.col("bs")), F.lit(0.0))
    at = laid.join(F.broadcast(starts), "part").select("score", over["g"].alias("go"), over["b"].alias("bo")).join(F.broadcast(totals))
    best = at.filter(lost <= LOST).agg(F.max_by("score", F.struct((caught - lost).alias("gain"), F.col("score"))).alias("score")).first()["score"]
    following = laid.filter(F.col("score") > best).agg(F.min("score").alias("s")).first()["s"]
    discard(laid)
    return best + 0.01 if following is None else (best + following) / 2


def _fitted(rows: DataFrame, seed: int = 5) -> Forest:
    """``fit`` of a table of statistics and ``good``.

    Box, counts and threshold come from every row that passes the base rules; the
    driver holds the trees and a count a node, whose number is fixed.
    """
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def shares(batches):
        for pdf in batches:
            pdf = pdf[~base_failed(pdf["n_words"], pdf["n_repeat_words"])]
            yield pd.DataFrame(features(pdf[names].to_numpy()), columns=AXES).assign(good=pdf["good"].to_numpy(dtype=bool))

    known = stored(rows.mapInPandas(shares, ", ".join(f"{a} double" for a in AXES) + ", good boolean"))
    box = known.agg(F.count_if("good").alias("n"), *[F.min(a).alias(f"low_{a}") for a in AXES], *[F.max(a).alias(f"high_{a}") for a in AXES]).first()
    if not box["n"]:
        discard(known)
        return Forest([])
    forest = drawn(np.array([box[f"low_{a}"] for a in AXES]), np.array([box[f"high_{a}"] for a in AXES]), seed)

    def count(batches):
        total = np.zeros((TREES, NODES), dtype=np.int64)
        for pdf in batches:
            total += counted(forest, pdf[AXES].to_numpy(dtype=float))
        tree, node = np.nonzero(total)
        yield pd.DataFrame({"tree": tree, "node": node, "n": total[tree, node]})

    counts = np.zeros((TREES, NODES))
    ends = known.filter("good").select(*AXES).mapInPandas(count, "tree long, node long, n long").groupBy("tree", "node").agg(F.sum("n").alias("n"))
    for r in ends.collect():  # at most a row a node
        counts[r["tree"], r["node"]] = r["n"]
    forest = weighed(forest, counts, box["n"])

    def scores(batches):
        for pdf in batches:
            yield pd.DataFrame({"score": forest.score(pdf[AXES].to_numpy(dtype=float)), "good": pdf["good"]})

    forest.threshold = _threshold(known.mapInPandas(scores, "score double, good boolean"))
    discard(known)
    return forest


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> Forest:
    """Fits on all labelled rows.

    Null labels and ids are left out.  An id that is labelled twice counts with
    each of its labels; one that ``docs`` repeats counts once, with its least
    statistics.  The order of rows changes nothing.  Without good rows, as of empty tables,
    nothing is anomalous.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), "quality").distinct()
    # texts stay where they are: it is their statistics that meet the labels
    rows = with_statistics(docs.select(F.col(id_col).alias("__id"), text), text).drop(text)
    names = [f.split()[0] for f in FIELDS.split(", ")]
    each = rows.filter("__id IS NOT NULL").groupBy("__id").agg(F.min(F.struct(*names)).alias("s")).join(known, "__id")
    return _fitted(each.select("s.*", (F.col("quality") > 0).alias("good")))


def judge(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """``docs`` with statistics, ``anomaly``, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rules.  Rows that repeat
    are judged alike, a row at the threshold itself stays, and columns named as
    the new ones are replaced.  A text of any length is counted whole, an empty table gives
    no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    names = [f.split()[0] for f in FIELDS.split(", ")]

    @F.pandas_udf(FIELDS + ", anomaly double")
    def measure(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([statistics(t) for t in texts], columns=names, dtype="int64")
        out["anomaly"] = shared.value.score(features(out.to_numpy()))
        return out

    rows = docs.withColumn("__q", measure(F.col(text)))
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns if c not in {*names, "anomaly", "base_failed", "kept"}], "__q.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("anomaly") <= F.lit(float(forest.threshold))))
