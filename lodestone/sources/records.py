"""Literature records out of nested JSON whose shape varies from record to record.

A text is parsed once into a VARIANT; typed paths are read out of it, each NULL (or empty) where the
path is missing or holds something else.  Texts that are no JSON object go to a quarantine
with the reason, and stop nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Publication types and notices that retract, question or correct a record.
RETRACTED_TYPES = ["retracted publication", "retraction of publication"]
CONCERN_TYPES = ["expression of concern"]
RETRACTION_NOTICES = ["retraction in"]
CONCERN_NOTICES = ["expression of concern in"]
CORRECTION_NOTICES = ["erratum in", "corrected and republished in"]


def parsed(rows: DataFrame, text: str, into: str = "json") -> DataFrame:
    """``rows`` with the VARIANT ``into`` and ``bad``: malformed, not_an_object, or NULL.  A NULL text is neither."""
    value = F.try_parse_json(F.col(text))
    kind = F.schema_of_variant(F.col(into))
    out = rows.withColumn(into, value)
    bad = F.when(F.col(text).isNotNull() & F.col(into).isNull(), "malformed").when(~kind.startswith("OBJECT"), "not_an_object")
    return out.withColumn("bad", bad)


def quarantined(rows: DataFrame) -> DataFrame:
    """Of ``parsed`` rows those that hold no record."""
    return rows.filter("bad IS NOT NULL").drop("json")


def get(value: Column, path: str, kind: str) -> Column:
    """What is at a path, if it can be read as ``kind``; else NULL."""
    return F.try_variant_get(value, path, kind)


def said(value: Column, path: str) -> Column:
    """Text at a path; nothing there is ''."""
    return F.coalesce(get(value, path, "string"), F.lit(""))


def listed(value: Column, path: str, kind: str = "string") -> Column:
    """A list at a path: what stands alone counts as a list of one; what is missing, null or empty as none."""
    many = get(value, path, "array<variant>")
    one = get(value, path, "variant")
    alone = F.when(one.isNotNull() & ~F.is_variant_null(one), F.array(one))
    items = F.transform(F.coalesce(many, alone), lambda x: F.try_variant_get(x, "$", kind))
    return F.coalesce(F.filter(items, lambda x: x.isNotNull() & (x.cast("string") != "")), F.array().cast(f"array<{kind}>"))


def _terms(items: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(items, F.lower)))


def _within(value: Column, path: str, field: str) -> Column:
    """A field of each object in a list."""
    return F.filter(F.transform(listed(value, path, "variant"), lambda x: F.try_variant_get(x, f"$.{field}", "string")), lambda x: x.isNotNull() & (x != ""))


def _any(items: Column, of: list[str]) -> Column:
    return F.arrays_overlap(items, F.array(*[F.lit(x) for x in of]))


def normalised(rows: DataFrame, value: str = "json") -> DataFrame:
    """One record a row: identifiers, title, journal, year, sorted lower-case types and terms, retraction state.

    ``key`` is the article number, else the lower-cased DOI, else ``source:id``; without any of them ''.
    Other columns of ``rows`` stay, except those named as the record's.
    """
    v = F.col(value)
    types, terms = _terms(listed(v, "$.pubTypeList.pubType")), _terms(_within(v, "$.meshHeadingList.meshHeading", "descriptorName"))
    notices = _terms(_within(v, "$.commentCorrectionList.commentCorrection", "type"))
    fields = {
        "id": said(v, "$.id"), "pmid": said(v, "$.pmid"), "pmcid": said(v, "$.pmcid"), "doi": F.lower(said(v, "$.doi")), "title": F.trim(said(v, "$.title")), "journal": said(v, "$.journalInfo.journal.title"),
        "year": said(v, "$.pubYear"), "source": said(v, "$.source"), "types": types, "terms": terms, "notices": notices, "abstract": said(v, "$.abstractText"),
    }
    out = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in {*fields, value, "key", "retracted", "concern", "corrected"}], *[x.alias(n) for n, x in fields.items()])
    own = F.when(F.col("id") != "", F.concat("source", F.lit(":"), "id")).otherwise("")
    return out.select(
        "*", F.coalesce(F.nullif("pmid", F.lit("")), F.nullif("doi", F.lit("")), own).alias("key"), (_any(F.col("types"), RETRACTED_TYPES) | _any(F.col("notices"), RETRACTION_NOTICES)).alias("retracted"),
        (_any(F.col("types"), CONCERN_TYPES) | _any(F.col("notices"), CONCERN_NOTICES)).alias("concern"), _any(F.col("notices"), CORRECTION_NOTICES).alias("corrected"),
    ).drop("notices")


def results(pages: DataFrame, text: str = "value", query: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of search answers, a row a text: ``{"pages": [{"resultList": {"result": [...]}}]}`` or one page.

    A record has ``page`` and ``nth``, its place in the answer, and the column ``query`` if named.
    """
    rows = parsed(pages, text)
    v, kept = F.col("json"), [F.col(query)] if query else []
    several = get(v, "$.pages", "array<variant>")
    each = rows.filter("bad IS NULL AND json IS NOT NULL").select(*kept, F.posexplode(F.coalesce(several, F.array(v))).alias("page", "answer"))
    found = each.select(*kept, "page", F.posexplode(listed(F.col("answer"), "$.resultList.result", "variant")).alias("nth", "json"))
    objects = F.schema_of_variant(F.col("json")).startswith("OBJECT")
    return normalised(found.filter(objects)), quarantined(rows)


def first_of_each(records: DataFrame, order: list[str], most: int, by: list[str] | None = None, parts: int = 32) -> DataFrame:
    """The first ``most`` records of each query, in order, with a key, a key once.

    A repeat goes by aggregation; then the best of each part of a query are kept before the shuffle
    that brings a query together, so a query of any size hands on ``parts * most`` rows at most.
    """
    from ..operators.records import capped

    by = by or []
    place = F.struct(*order)
    others = [c for c in records.columns if c not in {*by, "key"}]
    once = records.filter("key <> ''").groupBy(*by, "key").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in others]), place).alias("__r"))
    return capped(once.select(*by, "key", "__r.*"), by, [*order, "key"], most, parts)
