"""Writers: tables for people, atomic JSON, and the guards what leaves must pass."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lexical import forbidden


def publishable(df: DataFrame, fields: list[str]) -> DataFrame:
    """The listed fields and no other; a missing one is an error."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"fields that may leave are missing: {missing}")
    return df.select(*fields)


def strip_withheld(df: DataFrame, names: set[str]) -> DataFrame:
    """Drops the named fields at every depth of the schema."""

    def kept(col, kind):
        if isinstance(kind, T.StructType):
            fields = [f for f in kind.fields if f.name not in names]
            return F.when(col.isNotNull(), F.struct(*[kept(col[f.name], f.dataType).alias(f.name) for f in fields]))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return F.transform(col, lambda x: kept(x, kind.elementType))
        return col

    return df.select(*[kept(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if f.name not in names])


def withheld_keys(df: DataFrame, names: set[str]) -> list[str]:
    """Paths of withheld fields that the schema still has."""
    found = []

    def walk(kind, path):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                if f.name in names:
                    found.append(".".join([*path, f.name]))
                walk(f.dataType, [*path, f.name])
        elif isinstance(kind, T.ArrayType):
            walk(kind.elementType, path)

    walk(df.schema, [])
    return found


def guard(df: DataFrame) -> DataFrame:
    """Rows whose serialised form breaks a guard, with the guards' names; must be empty."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.withColumn("broken", forbidden(text)).filter(F.size("broken") > 0)


def write_tsv(df: DataFrame, path: str, order: list[str]) -> None:
    """A tab-separated table in order, NULL as an empty field, after its guard."""
    if not guard(df).isEmpty():
        raise ValueError("the table holds text that must not leave")
    df.orderBy(*order).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_json(path: str, value) -> None:
    """JSON with sorted keys, complete or absent."""
    part = f"{path}.{os.getpid()}.tmp"
    with open(part, "w", encoding="utf-8") as out:
        json.dump(value, out, sort_keys=True, indent=2, ensure_ascii=False)
        out.write("\n")
    os.replace(part, path)
