"""Stateless draws: a key and a seed give the same number anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, *parts: Column) -> Column:
    """An integer of 32 bits from the md5 of seed and parts, joined by ``|``."""
    key = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def draw_sql(seed: int, *parts: str) -> str:
    """The same draw in the oracle's SQL."""
    key = " || '|' || ".join([f"'{seed}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"


def without_replacement(digits: Column) -> Column:
    """Distinct numbers, ascending, of ``digits`` (the i-th below m - i): the i-th counts over what is still free.

    So a draw is the beginning of a permutation that its digits name, and costs a row a number
    drawn, not one a number of the pool.
    """

    def add(taken, digit):
        free = F.aggregate(taken, digit, lambda x, t: x + F.when(x >= t, 1).otherwise(0).cast("long"))
        return F.array_sort(F.array_append(taken, free))

    return F.aggregate(digits, F.array().cast("array<bigint>"), add)
