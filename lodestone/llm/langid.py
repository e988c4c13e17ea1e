"""Language identification by compression.

A raw-content zstandard dictionary per language holds labelled texts of that
language.  A text is cut into blocks, each block is compressed with each
dictionary, and the language whose dictionary leaves the fewest bytes wins.
The margin by which it wins over the second is the score.  A text is rejected if
the score is not above a margin for texts of its length: no margin at all (a
tie), or one as narrow as those of few correctly classified labelled texts.

The training sample is bounded: at most ``SAMPLE`` texts a language of at most
``SAMPLE_BYTES`` each, the rows of smallest hash in as many hash slots.  Three
quarters of them may enter the dictionaries, up to ``DICTIONARY_BYTES`` a
language; the rest sets the margins.  Everything else covers all rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled texts a language, bytes of each and bytes of a dictionary: the bounds of the sample.
SAMPLE = 1024
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 48_000
#: Blocks a text is compressed in; a longer one would fit itself, not the dictionary.
BLOCK = 3_000
LEVEL = 3
#: Share of correctly classified labelled texts of a length that their margin may reject, ties apart.
LOST = 0.005
#: Bytes at which the classes of length begin, and the fewest labelled texts that set a class's margin.
LENGTHS = (0, 64, 256, 1024, 4096)
FEWEST = 30
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def folded(text: str) -> bytes:
    """What is compressed: case tells styles apart, not languages."""
    return text.lower().encode("utf-8", "surrogatepass")


def length_class(text: str) -> int:
    """The class of a text's length in bytes."""
    n = len(text.encode("utf-8", "surrogatepass"))
    return max(k for k, least in enumerate(LENGTHS) if n >= least)


@dataclass
class Model:
    languages: list[str]
    dictionaries: list[bytes]
    margins: tuple = (0.0,) * len(LENGTHS)
    packed: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"languages": self.languages, "dictionaries": self.dictionaries, "margins": self.margins, "packed": []}

    def costs(self, text: str) -> np.ndarray:
        """Compressed bytes of the text under each dictionary."""
        import zstandard

        if not self.packed:
            for raw in self.dictionaries:
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self.packed.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False).compress)
        raw = folded(text)
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return np.array([sum(len(pack(b)) for b in blocks) for pack in self.packed], dtype=float)

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in [0, 1] and whether the margin is too narrow."""
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return UNKNOWN, 0.0, True
        costs = self.costs(text)
        order = np.lexsort((np.arange(len(costs)), costs))
        if len(costs) == 1:
            return self.languages[0], 1.0, False
        best, second = costs[order[0]], costs[order[1]]
        score = float((second - best) / second)
        return self.languages[order[0]], score, score <= self.margins[length_class(text)]


def sample(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> list[tuple[str, str]]:
    """At most ``SAMPLE`` labelled (language, text) rows a language, by hash; null texts are left out.

    Slots are by hash of the text, so copies meet in one; each slot's smallest
    hash is chosen in the map tasks already.
    """
    rows = docs.filter((F.octet_length(F.col(text)) <= SAMPLE_BYTES) & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h")
    )
    # only hashes are grouped; the texts of the chosen rows follow by a join with those few
    slots = rows.groupBy("lang", F.pmod(F.col("h"), F.lit(SAMPLE)).alias("slot")).agg(F.min("h").alias("h"))
    chosen = rows.join(F.broadcast(slots.select("lang", "h")), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))
    return sorted((r["lang"], r["text"]) for r in chosen.collect())


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model of (language, text) rows; the last quarter of each language sets the margins.

    A class of length with too few texts takes the margin of the next longer one.
    """
    by: dict[str, list[str]] = {}
    for lang, text in sorted(rows, key=lambda r: hashlib.md5(r[1].encode("utf-8", "surrogatepass")).digest()):
        if any(map(str.isalpha, text)):
            by.setdefault(lang, []).append(text)
    languages = sorted(by)
    dictionaries, held = [], []
    for lang in languages:
        texts = by[lang]
        n = max(1, len(texts) * 3 // 4)
        held += [(lang, t) for t in texts[n:]]
        out, room = [], DICTIONARY_BYTES
        for t in texts[:n]:
            raw = folded(t)
            if len(raw) <= room:  # whole texts only
                out.append(raw)
                room -= len(raw)
        dictionaries.append(b"\n".join(out) or b"\n".join(map(folded, texts[:1])))
    model = Model(languages, dictionaries)
    right: list[list[float]] = [[] for _ in LENGTHS]
    for lang, t in held:
        got, score, _ = model.classify(t)
        if got == lang and score > 0:
            right[length_class(t)].append(score)
    margins, longer = [], 0.0
    for scores in reversed(right):
        if len(scores) >= FEWEST:
            lost = int(LOST * len(scores))
            longer = sorted(scores)[lost - 1] if lost else min(scores) / 2
        margins.append(longer)
    model.margins = tuple(reversed(margins))
    return model


def _classified(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """``docs`` with a struct ``__lid`` of prediction, score and rejection."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def classify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.classify(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return docs.withColumn("__lid", classify(F.col(text)))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    A null or empty text, or one without a letter, is ``und`` with score 0 and
    rejected.  Ties go to the language first in code point order and are
    rejected.  Rows that repeat are judged alike; columns named as the three new
    ones are replaced.  A text of any length is compressed whole, block by block; an
    empty table gives no row.
    """
    out = _classified(docs, model, text)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "rejected")], "__lid.*")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Model:
    """A model of the rows of ``docs`` that are not held out; of an empty table one without languages, which rejects all."""
    return fit(sample(docs.filter(~held_out(F.col(id_col))), text, lang, id_col))


def drop_rejected(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose language is rejected, all columns as they are."""
    out = _classified(docs, learn(docs, text, lang, id_col), text)
    return out.filter("NOT __lid.rejected").drop("__lid")


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Learns from the rows of ``docs`` that are not held out and predicts all of them."""
    return predict(docs, learn(docs, text, lang, id_col), text)
