"""Identities: names, crosswalks, merging of records that share an identifier set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def name_index(names: DataFrame) -> DataFrame:
    """``name, id, ambiguous`` from (name, id, tier): the least id of the best tier.

    A name is ambiguous if its best tier holds several ids.
    """
    best = names.groupBy("name").agg(F.min("tier").alias("tier"))
    top = names.join(best, ["name", "tier"])
    return top.groupBy("name").agg(F.min("id").alias("id"), (F.countDistinct("id") > 1).alias("ambiguous"))


def fallback(keys: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """``key, code, via``: codes of the first listed id that has one, else codes by name.

    ``keys`` has key, ids (array, in order) and name; ``first`` (id, code),
    ``second`` (name, code).
    """
    tried = keys.select("key", F.posexplode("ids").alias("ord", "id")).join(first, "id")
    hit = tried.groupBy("key").agg(F.min_by("id", "ord").alias("id"))
    by_id = hit.join(first, "id").select("key", "code", F.lit("id").alias("via"))
    rest = keys.join(hit.select("key"), "key", "left_anti")
    return by_id.unionAll(rest.join(second, "name").select("key", "code", F.lit("name").alias("via")))


def merge_identical_sets(rows: DataFrame) -> DataFrame:
    """``key, survivor`` for (key, name, members): equal non-empty sets become one.

    The survivor has the shortest name, then the smallest key; blank names count
    as 99 characters.  Sets are grouped by their sorted members.
    """
    size = F.when(F.length(F.trim("name")) == 0, 99).otherwise(F.length("name"))
    keyed = rows.withColumn("whole", F.array_sort(F.array_distinct("members")))
    full = keyed.filter(F.size("whole") > 0)
    best = full.groupBy("whole").agg(F.min_by("key", F.struct(size, F.col("key"))).alias("survivor"))
    merged = full.join(best, "whole").select("key", "survivor")
    return merged.unionAll(keyed.filter((F.size("whole") == 0) | F.col("whole").isNull()).select("key", F.col("key").alias("survivor")))


def merge_identifiers(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """All records of a candidate's identifiers merged: distinct sections and statuses, sorted.

    ``candidates`` has key and ids (array); ``records`` identifier, section, status.
    """
    # a row an identifier: what candidates share is not multiplied by their number
    whole = records.groupBy("identifier").agg(F.collect_set("section").alias("sections"), F.collect_set("status").alias("statuses"), F.count("*").alias("n"))
    hits = candidates.select("key", F.explode(F.array_distinct("ids")).alias("identifier")).join(whole, "identifier")

    def merged(name: str, glue: str):
        return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))), glue).alias("text" if name == "sections" else name)

    return hits.groupBy("key").agg(merged("sections", " "), merged("statuses", "|"), F.sum("n").alias("n_records"))


def pooled(curated: DataFrame, retrieved: DataFrame, key: str) -> DataFrame:
    """The union of both, a curated row winning over a retrieved one of its key."""
    both = curated.withColumn("origin", F.lit("curated")).unionByName(retrieved.withColumn("origin", F.lit("retrieved")))
    w = Window.partitionBy(key).orderBy("origin", "ord")
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
