"""Reproducible sharding by a Feistel permutation of global row numbers.

Rows get global numbers without a global sort: a row's bucket comes from a hash
of its id and text, bucket counts are summed up to offsets (one row a bucket)
and rows are numbered inside their bucket.  A Feistel network over a mixed-radix
domain of just over n numbers, with cycle walking for the few outside, permutes
the numbers; the image alone gives shard (modulo) and slot (quotient).  Hashes
are md5 of values, so SQL computes the same shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import draw, draw_sql, let

#: Buckets of the numbering; the offsets table has a row for each of them.
BUCKETS = 4096
ROUNDS = 6
WALKS = 64
SHARDS, KEY = 16, 20_240_101


def row_numbers(df: DataFrame, keys: list[Column], buckets: int = BUCKETS) -> DataFrame:
    """Adds ``row_no`` (0 to n - 1, each once) and ``n_rows``.

    The order is that of a hash of ``keys``, then of the keys; rows equal in all
    keys are interchangeable and take consecutive numbers.
    """
    hashed = df.withColumn("__h", draw(*keys))
    # the top bits choose the bucket; a bucket's rows are of different keys, so no key makes it large
    hashed = hashed.withColumn("__b", F.pmod(F.shiftright(F.col("__h"), 20), F.lit(buckets)).cast("int"))
    counts = hashed.groupBy("__b").agg(F.count("*").alias("__n"))
    every = Window.orderBy("__b")
    offsets = counts.select(
        "__b",
        (F.sum("__n").over(every.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n")).alias("__start"),
        F.sum("__n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_rows"),
    )
    inside = Window.partitionBy("__b").orderBy("__h", *[k.asc_nulls_last() for k in keys])
    numbered = hashed.withColumn("__i", F.row_number().over(inside))
    return (
        numbered.join(F.broadcast(offsets), "__b")  # at most `buckets` rows
        .withColumn("row_no", F.col("__start") + F.col("__i") - 1)
        .drop("__h", "__b", "__i", "__start")
    )


def _round(half: Column, key: int, k: int, size: Column) -> Column:
    return draw(half, F.lit(key), F.lit(k)) % size


def permute(x: Column, n: Column, key: int) -> Column:
    """A keyed permutation of 0 to n - 1, computed from ``x`` and ``n`` alone.

    The halves are digits to bases a and b with a * b just over n.  A number
    that leaves the range walks on along its cycle until it is inside again.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    b = F.ceil(n.cast("double") / a).cast("bigint") + 1

    def once(s):
        out = F.struct(F.floor(s / b).cast("bigint").alias("l"), F.pmod(s, b).alias("r"))

        def of(k):
            def go(t):
                if k % 2:
                    return F.struct(t["l"].alias("l"), F.pmod(t["r"] + _round(t["l"], key, k, b), b).alias("r"))
                return F.struct(F.pmod(t["l"] + _round(t["r"], key, k, a), a).alias("l"), t["r"].alias("r"))

            return go

        for k in range(ROUNDS):
            out = let(out, of(k))
        return let(out, lambda t: t["l"] * b + t["r"])

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        F.struct(x.alias("x"), F.lit(False).alias("done")),
        lambda s, _: F.when(s["done"], s).otherwise(let(once(s["x"]), lambda y: F.struct(y.alias("x"), (y < n).alias("done")))),
        lambda s: F.when(s["done"], s["x"]).otherwise(F.raise_error(F.lit("no end of a walk")).cast("bigint")),
    )
    return walked


def shard(df: DataFrame, shards: int = SHARDS, text: str = "text", id_col: str = "doc_id", key: int = KEY) -> DataFrame:
    """One row per document with its ``shard`` and ``slot``; counts differ by one at most.

    ``size`` is the text's UTF-8 bytes plus 1 and ``text_crc32`` its unsigned
    CRC-32; a null text has no bytes.  Null ids take part like any other value.
    Rows equal in id and text are interchangeable.  Other columns are not read; an
    empty table gives an empty result.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    numbered = row_numbers(rows, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    placed = numbered.withColumn("at", permute(F.col("row_no"), F.col("n_rows"), key))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(F.col("at"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("at") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _crc_sql() -> str:
    """``v``'s register after one more zero byte: the step is linear, so a constant for each low bit."""
    return "xor(v >> 8, " + "".join(f"xor(((v >> {b}) & 1) * {c}, " for b, c in enumerate(_BITS)) + "0" + ")" * 9


def _bit(b: int) -> int:
    v = 1 << b
    for _ in range(8):
        v = (v >> 1) ^ (0xEDB88320 if v & 1 else 0)
    return v


_BITS = [_bit(b) for b in range(8)]


def _feistel_sql(x: str, source: str) -> str:
    """One pass of the network over ``x`` of rows with a, b and n."""
    q = f"SELECT *, ({x}) // b AS l, ({x}) % b AS r FROM {source}"
    for k in range(ROUNDS):
        moved = f"l, (r + {draw_sql('l', str(KEY), str(k))} % b) % b AS r" if k % 2 else f"(l + {draw_sql('r', str(KEY), str(k))} % a) % a AS l, r"
        q = f"SELECT row_no, a, b, n, {moved} FROM ({q})"
    return f"SELECT row_no, a, b, n, l * b + r AS x FROM ({q})"


_STEP = _crc_sql()
#: A text's checksum is that of as many zero bytes, changed by every bit's own constant, moved on by the bytes after it.
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) AS BIGINT) AS len, row_number() OVER () AS id FROM documents),
pw AS (SELECT CAST(0 AS BIGINT) AS far, CAST(4294967295 AS BIGINT) AS z, {', '.join(f'CAST({c} AS BIGINT) AS t{b}' for b, c in enumerate(_BITS))}
  UNION ALL SELECT far + 1, {', '.join(f"{_STEP.replace('v', v)} AS {v}" for v in ['z', *(f't{b}' for b in range(8))])} FROM pw WHERE far < (SELECT max(len) FROM d)),
bytes AS (SELECT id, len - 1 - unnest(range(len)) AS far, CAST('0x' || unnest(regexp_extract_all(hex(encode(t)), '..')) AS BIGINT) AS v FROM d WHERE len > 0),
crc AS (SELECT id, bit_xor({"".join(f"xor(((v >> {b}) & 1) * t{b}, " for b in range(8))}0{")" * 8}) AS c FROM bytes JOIN pw USING (far) GROUP BY id),
k AS (SELECT d.id, doc_id, len + 1 AS size, xor(xor(z, coalesce(c, 0)), 4294967295) AS text_crc32 FROM d JOIN pw ON pw.far = d.len LEFT JOIN crc ON crc.id = d.id),
h AS (SELECT *, {draw_sql('doc_id', 'text_crc32', 'size')} AS h FROM k),
num AS (SELECT *, row_number() OVER (ORDER BY (h >> 20) % {BUCKETS}, h, doc_id NULLS LAST, text_crc32, size) - 1 AS row_no, count(*) OVER () AS n FROM h),
ab AS (SELECT n, a, CAST(ceil(CAST(n AS DOUBLE) / a) AS BIGINT) + 1 AS b FROM (SELECT any_value(n) AS n, CAST(ceil(sqrt(CAST(any_value(n) AS DOUBLE))) AS BIGINT) AS a FROM num)),
w AS ({_feistel_sql('row_no', '(SELECT row_no, ab.* FROM num, ab)')}
  UNION ALL {_feistel_sql('x', 'w WHERE x >= n')})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {SHARDS} AS INTEGER) AS shard, CAST(x // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM num JOIN w USING (row_no) WHERE x < w.n
"""
