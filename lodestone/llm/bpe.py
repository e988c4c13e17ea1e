"""Byte-level BPE: encoding by folded merges, decoding by concatenation.

Words (matches of the pre-tokenizer's pattern) are byte strings.  A fold over
the byte positions of a word carries the cuts between its parts and the rank of
every adjacent pair, merges the leftmost pair of lowest rank and looks up the
two pairs this makes new, until no pair has a rank.  Ranks stand in the plan as
one constant: an array of small maps, indexed by a hash of the bytes, because a
single map would be searched entry by entry.  The constant is a scalar
subquery, so tasks receive it as one block of bytes, not as an object graph.

:func:`encode_native` is that fold in Spark's higher-order functions.  They are
interpreted and take several times what a corpus can afford (figures in the
README), so :func:`encode` runs the same merges in Arrow
batches: each worker folds distinct words, all of one length a merge at a time,
keeps their ids in a bounded cache and looks them up for every other occurrence.
Nothing is shuffled.  A full cache is emptied, so its bound never changes a
result.  Words of more than ``LONG_BYTES`` bytes are merged with a heap, since
the fold is quadratic in a word's length.

In the native form bytes travel as strings whose code points are 0 to 255 (ISO 8859-1).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let

NONE = 2_147_483_647
LONG_BYTES = 200
#: Words a worker keeps; at about 150 bytes each.
CACHE_WORDS = 400_000
#: Unicode's White_Space; Java's own class holds ASCII only.
WHITE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def java_pattern(pattern: str) -> str:
    r"""The pre-tokenizer's pattern with ``\s`` and ``\S`` spelled out for Java."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            two = pattern[i : i + 2]
            if two == r"\s":
                out.append(WHITE if inside else f"[{WHITE}]")
            elif two == r"\S":
                if inside:
                    raise ValueError("a negated class inside a class is not supported")
                out.append(f"[^{WHITE}]")
            else:
                out.append(two)
            i += 2
            continue
        inside = (inside or c == "[") and c != "]"
        out.append(c)
        i += 1
    return "".join(out)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 bytes and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _constant(spark: SparkSession, entries: dict[str, object], value_type: str) -> Column:
    """A constant array of maps; :func:`_lookup` finds a key in one of them."""
    slots: list[dict] = [{} for _ in range(max(1, len(entries) // 3))]
    for k, v in entries.items():
        h = xxhash.xxh64_intdigest(k.encode(), 42)
        slots[(h - (1 << 64) if h >> 63 else h) % len(slots)][k] = v
    text = json.dumps(slots, separators=(",", ":"), ensure_ascii=True)
    return spark.createDataFrame([(text,)], "t string").select(F.from_json("t", f"array<map<string,{value_type}>>").alias("t")).scalar()


def _table(k: int) -> str:
    return f"__bpe_table{k}"


def _with(df: DataFrame, constants: list[Column]) -> DataFrame:
    """``df`` with constants as columns, each to be used once.

    Spark takes no subquery as an argument of a higher-order function; a column
    that is used once is put in its place by the optimizer all the same.
    """
    return df.withColumns({_table(k): c for k, c in enumerate(constants)})


def _lookup(table: Column, key: Column) -> Column:
    return F.try_element_at(F.get(table, F.pmod(F.xxhash64(key), F.size(table)).cast("int")), key)


def _bytes_of(word: Column) -> Column:
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def _fold(word: Column, ranks: Column) -> Column:
    """Ids of one word, given as a string of its bytes."""

    def rank(cuts, a, b):
        start = F.get(cuts, a)
        return F.coalesce(_lookup(ranks, F.substring(w_ref[0], start, F.get(cuts, b) - start)), F.lit(NONE))

    w_ref: list[Column] = []

    def of(w: Column) -> Column:
        w_ref[:] = [w]
        n = F.length(w)
        pairs = F.when(n < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 2))
        start = F.struct(
            F.sequence(F.lit(1), n + 1).alias("cuts"),
            F.transform(pairs, lambda i: F.coalesce(_lookup(ranks, F.substring(w, i + 1, F.lit(2))), F.lit(NONE))).alias("ranks"),
        )

        def step(s, _):
            least = F.array_min(s["ranks"])

            def merge(p):  # p: 0-based index of the pair that is merged
                cuts, old = s["cuts"], s["ranks"]
                left = F.when(p > 0, F.array(rank(cuts, p - 1, p + 2))).otherwise(F.array().cast("array<int>"))
                right = F.when(p + 1 < F.size(old), F.array(rank(cuts, p, p + 3))).otherwise(F.array().cast("array<int>"))
                return F.struct(
                    F.concat(F.slice(cuts, F.lit(1), p + 1), F.slice(cuts, p + 3, F.size(cuts))).alias("cuts"),
                    F.concat(F.slice(old, F.lit(1), F.greatest(p - 1, F.lit(0))), left, right, F.slice(old, p + 3, F.size(old))).alias("ranks"),
                )

            return F.when(F.coalesce(least, F.lit(NONE)) == NONE, s).otherwise(let((F.array_position(s["ranks"], least) - 1).cast("int"), merge))

        def ids(s):
            return F.transform(
                F.sequence(F.lit(0), F.size(s["cuts"]) - 2),
                lambda i: _lookup(ranks, F.substring(w, F.get(s["cuts"], i), F.get(s["cuts"], i + 1) - F.get(s["cuts"], i))),
            )

        return F.coalesce(F.transform(F.array(_lookup(ranks, w)), lambda one: F.when(one.isNotNull(), F.array(one)))[0], F.aggregate(pairs, start, step, ids))

    return let(word, of)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap: for words too long for the fold."""
    n = len(word)
    end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    after = [i + 1 if i + 1 < n else -1 for i in range(n)]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else -1
        if j < 0 or end[j] != stop:
            continue
        end[i], alive[j], after[i] = stop, False, after[j]
        if after[i] >= 0:
            prev[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i] : stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


class Merges:
    """The rank map as arrays: which ids merge, and into which.

    An id is a rank.  Pieces merge by their bytes, whatever they were made of,
    so every cut of a piece into two pieces is an entry.
    """

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for piece, r in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.keys = np.array(sorted(pairs), np.int64)
        self.into = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.ranks = ranks

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(key.shape, NONE, np.int32)
        return np.where(self.keys[at] == key, self.into[at], NONE)

    def fold(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; words of one length advance together, a merge a step."""
        out: list = [None] * len(words)
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:
                out[k] = np.array([whole], np.int32)
            elif len(w) > LONG_BYTES:
                out[k] = np.array(merge_long(w, self.ranks), np.int32)
            else:
                by.setdefault(len(w), []).append(k)
        for n, places in by.items():
            where = np.array(places)
            tokens = self.bytes[np.frombuffer(b"".join(words[k] for k in places), np.uint8).reshape(-1, n)]
            pairs = self.of(tokens[:, :-1], tokens[:, 1:])
            while len(where):
                left = tokens.shape[1]
                at = pairs.argmin(1) if left > 1 else np.zeros(len(where), np.int64)
                least = pairs[np.arange(len(where)), at] if left > 1 else np.full(len(where), NONE)
                done = least == NONE
                for k, ids in zip(where[done].tolist(), tokens[done]):
                    out[k] = ids
                go = ~done
                where, tokens, pairs, at, least = where[go], tokens[go], pairs[go], at[go], least[go]
                if not len(where):
                    break
                rows = np.arange(len(where))
                tokens[rows, at] = least
                tokens = np.take_along_axis(tokens, np.arange(left - 1) + (np.arange(left - 1) > at[:, None]), 1)
                pairs = np.take_along_axis(pairs, np.arange(left - 2) + (np.arange(left - 2) >= at[:, None]), 1) if left > 2 else pairs[:, :0]
                a = rows[at > 0]
                if left > 2 and len(a):
                    pairs[a, at[a] - 1] = self.of(tokens[a, at[a] - 1], tokens[a, at[a]])
                b = rows[at < left - 2]
                if len(b):
                    pairs[b, at[b]] = self.of(tokens[b, at[b]], tokens[b, at[b] + 1])
        return out


class _Folded:
    """Ids of the words a worker has met, at most ``most`` of them."""

    def __init__(self, merges: Merges, most: int):
        self.merges, self.most = merges, most
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.int32)

    def ids(self, lists: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of words."""
        if len(self.place) > self.most:
            self.clear()
        new = list(set().union(*lists).difference(self.place)) if lists else []
        if new:
            folded = self.merges.fold([w.encode("utf-8", "surrogatepass") for w in new])
            base = len(self.place)
            self.place.update(zip(new, range(base, base + len(new))))
            ends = self.starts[-1] + np.cumsum([len(x) for x in folded])
            self.starts, self.flat = np.concatenate([self.starts, ends]), np.concatenate([self.flat, *folded])
        out = []
        place = self.place.__getitem__
        for words in lists:
            at = np.fromiter(map(place, words), np.int64, len(words))
            first, counts = self.starts[at], self.starts[at + 1] - self.starts[at]
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.flat[np.arange(total) + np.repeat(first - (ends - counts), counts)])
        return out


def _passes(df: DataFrame, text: str, ranks: dict[bytes, int], pattern: str, cache_words: int):
    """A function from Arrow batches to (slice of a batch, ids of its rows)."""
    # As large as the vocabulary, whatever the corpus.  A worker holds on to what it
    # has unpacked, so the words it has folded stay for its next task.
    shared = df.sparkSession.sparkContext.broadcast((ranks, []))

    def passes(it):
        import regex

        table, kept = shared.value
        if not kept:
            kept.append(_Folded(Merges(table), cache_words))
        folded, find = kept[0], regex.compile(pattern).findall
        for batch in it:
            column, part, size, start = batch.column(text), [], 0, 0
            for row in range(batch.num_rows):
                t = column[row].as_py()
                part.append(find(t) if t else [])
                size += len(part[-1])
                if size > 100_000 or row == batch.num_rows - 1:
                    yield batch.slice(start, row + 1 - start), folded.ids(part)
                    part, size, start = [], 0, row + 1

    return passes


def encode(df: DataFrame, text: str, ranks: dict[bytes, int], pattern: str, out: str = "ids", cache_words: int = CACHE_WORDS) -> DataFrame:
    """``df`` with the token ids of column ``text`` as ``array<int>`` column ``out``.

    A null or empty text has no ids.  No special token is ever made.  An
    existing column ``out`` is replaced; all others are kept.
    """
    df = df.drop(out) if out != text else df.withColumnRenamed(out, "__text")
    text = text if out != text else "__text"
    passes = _passes(df, text, ranks, pattern, cache_words)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(it):
        import pyarrow as pa

        for batch, ids in passes(it):
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema).drop("__text")


def round_trip(df: DataFrame, text: str, id_col: str, ranks: dict[bytes, int], pattern: str, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Encodes and decodes every text in one pass over it; returns digests of both.

    ``id_col, n_tokens, ids_sha256`` (decimal ids joined by a space) and
    ``decoded_sha256`` (their pieces joined).  A null text is an empty one, with the digests of
    nothing; rows that repeat give a row each, a text of any length is encoded whole, an
    empty table gives no row.
    """
    rows = df.select(id_col, text)
    passes = _passes(rows, text, ranks, pattern, cache_words)
    pieces = _pieces(ranks)
    schema = T.StructType([df.schema[id_col], *(T.StructField(n, t) for n, t in (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())))])

    def run(it):
        import pyarrow as pa

        names = [str(i) for i in range(len(pieces))]
        for batch, lists in passes(it):
            plain = [x.tolist() for x in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    pa.array(map(len, plain), pa.int64(), size=len(plain)),
                    pa.array([hashlib.sha256(" ".join(map(names.__getitem__, x)).encode()).hexdigest() for x in plain], pa.string()),
                    pa.array([hashlib.sha256(b"".join(map(pieces.__getitem__, x))).hexdigest() for x in plain], pa.string()),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(run, schema)


def encode_native(df: DataFrame, text: str, ranks: dict[bytes, int], pattern: str, out: str = "ids") -> DataFrame:
    """What :func:`encode` returns, by higher-order functions alone; quadratic in the longest word."""
    table = _constant(df.sparkSession, {k.decode("latin-1"): v for k, v in ranks.items()}, "int")
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))
    df = _with(df.withColumn("__bpe_words", words), [table])
    ids = let(F.col(_table(0)), lambda t: F.transform("__bpe_words", lambda w: _fold(_bytes_of(w), t)))
    return df.withColumn(out, F.flatten(ids)).drop("__bpe_words", _table(0))


def _pieces(ranks: dict[bytes, int]) -> list:
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for k, v in ranks.items():
        pieces[v] = k
    return pieces


def decode(df: DataFrame, ids: str, ranks: dict[bytes, int], out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of an ``array<int>`` of ids, their pieces concatenated.

    Null ids give null; an id that the vocabulary lacks raises an error.
    """
    names: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for k, v in ranks.items():
        names[v] = k.decode("latin-1")
    table = df.sparkSession.createDataFrame([(json.dumps(names),)], "t string").select(F.from_json("t", "array<string>").alias("t")).scalar()
    unknown = F.raise_error(F.lit("an id without a piece")).cast("string")
    piece = let(F.col(_table(0)), lambda t: F.transform(ids, lambda i: F.coalesce(F.get(t, i), unknown)))
    return _with(df, [table]).withColumn(out, F.encode(F.array_join(piece, ""), "ISO-8859-1")).drop(_table(0))


def digests(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for column ``ids``."""

    return (
        decode(df, ids, ranks, "__decoded")
        .withColumn("n_tokens", F.size(ids).cast("long"))
        .withColumn("ids_sha256", F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256))
        .withColumn("decoded_sha256", F.sha2("__decoded", 256))
        .drop("__decoded")
    )
