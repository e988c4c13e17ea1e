"""Toxicity by a factorization machine over hashed terms.

Features of a text are the terms that occur in it and their beginnings (inflected and
compounded forms share a stem), hashed to ``DIM`` buckets.  The score of a set of features is

    w0 + sum of w_i + sum over pairs i < j of <v_i, v_j>

so a pair can be toxic (an insult and a mention of a group) whose members are not, which
no additive weights express.  The pairs' sum comes from ``(|sum v|^2 - sum |v|^2) / 2``.

Learning is bounded: at most ``SAMPLE`` labelled rows, those of the smallest hash, and of
their buckets the ``FEATURES`` that tell the labels apart best.  Rows that are near copies of each
other count as one, else the words they happen to share would pass for toxic ones.
Executors extract and count; the driver gets the kept buckets of the sample.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, term_bytes

DIM = 1 << 22
SAMPLE = 16_384
FEATURES = 4096
RANK = 8
#: Beginnings of a term that are features, in code points.
STEMS = range(3, 9)
#: Least evidence (log-likelihood ratio) and weight of a bucket that is learned.
EVIDENCE, SEEN = 15.0, 3.0
EPOCHS, BATCH, RATE, L1, L2 = 30, 128, 0.02, 2e-4, 2e-3
#: Terms that a worker remembers; changes no result.
CACHE_TERMS = 400_000


def buckets(term: bytes) -> list[int]:
    """The buckets of a term and of its beginnings."""
    text = term.decode()
    parts = [b"=" + term] + [b"^" + text[:n].encode() for n in STEMS if n <= len(text)]
    return [zlib.crc32(p) % DIM for p in parts]


@dataclass
class Machine:
    """``slots`` maps a bucket to its row of ``w`` and ``v``."""

    slots: dict[int, int] = field(default_factory=dict)
    w0: float = -4.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))
    v: np.ndarray = field(default_factory=lambda: np.zeros((0, RANK)))

    def margin(self, active: np.ndarray) -> float:
        """The score of one text's distinct features, as a logit."""
        v = self.v[active]
        return float(self.w0 + self.w[active].sum() + ((v.sum(0) ** 2).sum() - (v**2).sum()) / 2)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class _Rows:
    """Feature lists of many texts, end to end."""

    def __init__(self, lists: list):
        self.lengths = np.array([len(x) for x in lists], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.ids = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if lists else np.zeros(0, dtype=np.int64)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of the given rows, and the place of the row each belongs to."""
        n = self.lengths[rows]
        row = np.repeat(np.arange(len(rows)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.ids[self.starts[rows][row] + within], row


def _forward(w0, w, v, ids, row, n):
    sums = np.stack([np.bincount(row, v[ids, f], n) for f in range(v.shape[1])], 1)
    squares = np.bincount(row, (v[ids] ** 2).sum(1), n)
    return w0 + np.bincount(row, w[ids], n) + ((sums**2).sum(1) - squares) / 2, sums


def train(lists: list, toxic: np.ndarray, weights: np.ndarray, n_features: int, epochs: int = EPOCHS, seed: int = 11) -> tuple[float, np.ndarray, np.ndarray]:
    """Weights of a machine by Adam on the weighted logistic loss; small linear weights are driven to zero.

    A fifth of the rows is held back to set w0, so that 0.5 lies where their labels part best.
    """
    rng = np.random.default_rng(seed)
    rows, y = _Rows(lists), np.asarray(toxic, dtype=float)
    back = rng.random(len(y)) < 0.2
    own = np.flatnonzero(~back)
    prior = np.clip(np.average(y, weights=weights), 1e-3, 1 - 1e-3)
    params = {"w0": np.array([np.log(prior / (1 - prior))]), "w": np.zeros(n_features), "v": rng.normal(0, 0.02, (n_features, RANK))}
    first = {k: np.zeros_like(p) for k, p in params.items()}
    second = {k: np.zeros_like(p) for k, p in params.items()}
    step = 0
    for _ in range(epochs if len(own) else 0):
        order = rng.permutation(own)
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            ids, row = rows.take(part)
            z, sums = _forward(params["w0"][0], params["w"], params["v"], ids, row, len(part))
            slope = (_sigmoid(z) - y[part]) * weights[part]
            slope /= weights[part].sum()
            each = slope[row]
            gradient = {"w0": np.array([slope.sum()]), "w": np.bincount(ids, each, n_features)}
            change = each[:, None] * (sums[row] - params["v"][ids])
            gradient["v"] = np.stack([np.bincount(ids, change[:, f], n_features) for f in range(RANK)], 1) + L2 * params["v"]
            step += 1
            for k, p in params.items():
                first[k] = 0.9 * first[k] + 0.1 * gradient[k]
                second[k] = 0.999 * second[k] + 0.001 * gradient[k] ** 2
                p -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            params["w"] = np.sign(params["w"]) * np.maximum(np.abs(params["w"]) - RATE * L1, 0)
    held = np.flatnonzero(back) if y[back].sum() and (1 - y[back]).sum() else np.arange(len(y))
    ids, row = rows.take(held)
    z, _ = _forward(params["w0"][0], params["w"], params["v"], ids, row, len(held))
    return float(params["w0"][0] - _parting(z, y[held], weights[held])), params["w"], params["v"]


def _parting(z: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The margin that parts the labels with the least weight of errors; in the middle where many do."""
    if not y.sum() or y.all():
        return 0.0
    order = np.argsort(z, kind="stable")
    z, toxic = z[order], np.where(y[order] > 0, weights[order], 0)
    clean = np.where(y[order] > 0, 0, weights[order])
    wrong = np.concatenate([[0], np.cumsum(toxic)]) + clean.sum() - np.concatenate([[0], np.cumsum(clean)])
    edges = np.concatenate([[z[0] - 1], (z[:-1] + z[1:]) / 2, [z[-1] + 1]])
    wide = np.concatenate([[0], z[1:] - z[:-1], [0]])  # no cut between equal margins
    best = np.lexsort((-wide, np.where(wide > 0, wrong, np.inf)))[0]
    return float(edges[best]) if wide[best] > 0 else 0.0


def learned_from(id_col: Column) -> Column:
    """Whether a row's label may be learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 != 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES) -> Machine:
    """Fits a machine on at most ``sample`` labelled rows whose labels may be learned from.

    Null labels and ids are left out; an id labelled twice counts with each label, a row that
    ``docs`` repeats counts each time.  Without rows of both labels nothing scores above 0.5.
    The order of rows changes nothing.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & learned_from(F.col(id_col)))
    chosen = known.orderBy(F.xxhash64(F.col(id_col)), id_col, label).limit(sample).select(F.col(id_col).alias("__id"), (F.col(label) > 0).cast("int").alias("toxic"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("__id"))

    @F.pandas_udf("kin long, buckets array<int>")
    def extract(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            terms = set(term_bytes(t))
            # near copies share the least hash of their terms, and mostly nothing else does
            kin = min(((zlib.crc32(x, 7) << 32) + zlib.crc32(x) for x in terms if len(x) > 5), default=-1)
            out.append((kin % (1 << 63) if kin >= 0 else -1, sorted({b for x in terms for b in buckets(x)})))
        return pd.DataFrame(out, columns=["kin", "buckets"])

    seen = stored(rows.select("id", "toxic", extract("text").alias("x")).select("id", "toxic", "x.*"))
    # the sample is bounded, and so are its families and buckets
    kin = seen.groupBy("toxic", "kin").agg((1 / F.count("*")).alias("weight"))
    kin = kin.withColumn("weight", F.when(F.col("kin") < 0, 1.0).otherwise(F.col("weight")))
    seen = stored(seen.join(F.broadcast(kin), ["toxic", "kin"]))
    total = seen.groupBy().agg(F.sum(F.col("weight") * F.col("toxic")).alias("t"), F.sum(F.col("weight") * (1 - F.col("toxic"))).alias("c")).first()
    if not total.t or not total.c:
        return Machine()
    counts = seen.select("toxic", "weight", F.explode("buckets").alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.sum(F.col("weight") * F.col("toxic")).alias("t"), F.sum(F.col("weight") * (1 - F.col("toxic"))).alias("c"))
    every = total.t + total.c

    def part(count, row, column):
        return F.when(count > 0, count * F.log(count * every / (row * column))).otherwise(0.0)

    t, c = F.greatest(F.round("t", 9), F.lit(0.0)), F.greatest(F.round("c", 9), F.lit(0.0))
    apart = 2 * (part(t, t + c, F.lit(total.t)) + part(c, t + c, F.lit(total.c)) + part(total.t - t, every - t - c, F.lit(total.t)) + part(total.c - c, every - t - c, F.lit(total.c)))
    best = counts.withColumn("apart", F.round(apart, 6)).filter((F.col("apart") >= EVIDENCE) & (F.col("t") + F.col("c") >= SEEN))
    found = sorted(r.bucket for r in best.orderBy(F.desc("apart"), "bucket").limit(features).select("bucket").collect())
    slots = {b: i for i, b in enumerate(found)}
    some = F.array_intersect("buckets", F.lit(found).cast("array<int>")) if found else F.array().cast("array<int>")
    fitted = seen.select("id", "toxic", "weight", some.alias("buckets")).collect()  # at most ``sample`` rows
    fitted.sort(key=lambda r: (str(r.id), r.toxic, r.buckets))
    lists = [sorted(slots[b] for b in r.buckets) for r in fitted]
    w0, w, v = train(lists, np.array([r.toxic for r in fitted]), np.array([r.weight for r in fitted]), len(slots))
    return Machine(slots, w0, w, v)


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    A null or empty text has no features and gets the score of w0 alone.  A repeated
    term counts once, a text of any length is read whole, rows that repeat score alike,
    columns named as the new ones are replaced, an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, known = shared.value, {}
        for texts in batches:
            margins = []
            for text_bytes in texts:
                active: set[int] = set()
                for term in set(term_bytes(text_bytes)):
                    got = known.get(term)
                    if got is None:
                        if len(known) >= CACHE_TERMS:
                            known.clear()
                        got = known[term] = tuple(m.slots[b] for b in buckets(term) if b in m.slots)
                    if got:
                        active.update(got)
                margins.append(m.margin(np.array(sorted(active), dtype=np.int64)))
            yield pd.Series(_sigmoid(np.array(margins, dtype=float)))

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, judge(F.col(text).cast("binary")).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
