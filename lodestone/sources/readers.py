"""Readers with declared schemas: variant text, edges, ontologies, archives, records."""

from __future__ import annotations

import hashlib
import io
import json
import os
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.alleles import bare_contig, info_map, review_stars, significance_class

VCF = "contig string, pos bigint, id string, ref string, alts array<string>, filter array<string>, info map<string,string>, sample map<string,string>"
RECORD = "id string, source string, pmid string, doi string, title string, journalTitle string, pubYear string, abstractText string, pubTypeList struct<pubType:array<string>>, meshHeadingList struct<meshHeading:array<struct<descriptorName:string>>>"


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` if it has the columns; a wrong delimiter or a changed format stops here."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}; found {df.columns}")
    return df


def not_empty(df: DataFrame, what: str) -> DataFrame:
    """``df`` unless it is empty: at a layer's edge emptiness means broken input."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def read_vcf(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per line of a variant file of at most one sample; compressed files are respread; see ``read_block_vcf`` for block-gzip."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#"))
    return parsed_vcf(lines.repartition(partitions) if partitions else lines)


def read_block_vcf(spark: SparkSession, path: str, regions: str | None = None) -> DataFrame:
    """Rows of block-gzipped variant files, read in splits; of regions (``1:100-200,2``) only the blocks that hold them."""
    from . import bgzf

    bgzf.register(spark)
    source = spark.read.format("bgzf")
    return parsed_vcf((source.option("regions", regions) if regions else source).load(path).select("value"))


def parsed_vcf(lines: DataFrame) -> DataFrame:
    """Lines of a variant file (column value, no comments) as rows."""
    parts = F.split("value", "\t")
    f = [F.get(parts, F.lit(k)) for k in range(10)]  # an element that is not there is NULL, whatever runs first
    listed = lambda c, sep: F.filter(F.split(c, sep), lambda x: ~x.isin("", "."))
    sample = F.when(f[9].isNotNull(), F.map_from_arrays(F.split(f[8], ":"), F.slice(F.concat(F.split(f[9], ":"), F.array_repeat(F.lit("."), 64)), F.lit(1), F.size(F.split(f[8], ":")))))
    return lines.select(
        f[0].alias("contig"), f[1].cast("bigint").alias("pos"), f[2].alias("id"), f[3].alias("ref"), listed(f[4], ",").alias("alts"), listed(f[6], ";").alias("filter"),
        info_map(f[7]).alias("info"), sample.alias("sample"),
    )


def allele_sites(vcf: DataFrame, pass_only: bool = True) -> DataFrame:
    """Biallelic single-base sites with read depths: contig, pos, ref, alt, het, passing."""
    ad = F.transform(F.split(F.col("sample")["AD"], ","), lambda x: x.try_cast("int"))
    gt = F.array_sort(F.filter(F.transform(F.split(F.col("sample")["GT"], r"[/|]"), lambda x: x.try_cast("int")), lambda x: x.isNotNull()))
    single = (F.length("ref") == 1) & (F.size("alts") == 1) & (F.length(F.get("alts", F.lit(0))) == 1)
    passing = (F.size("filter") == 0) | F.array_contains("filter", "PASS")
    out = vcf.filter(single).select(
        "contig", "pos", F.get(ad, F.lit(0)).alias("ref"), F.get(ad, F.lit(1)).alias("alt"), (gt == F.array(F.lit(0), F.lit(1))).alias("het"), (passing if pass_only else F.lit(True)).alias("passing")
    )
    return out.filter("ref IS NOT NULL AND alt IS NOT NULL")


def alleles(vcf: DataFrame) -> DataFrame:
    """A row per carried alternative: zygosity, filter text, whether its partner is another alternative."""
    called = F.filter(F.transform(F.split(F.col("sample")["GT"], r"[/|]"), lambda x: x.try_cast("int")), lambda x: x.isNotNull())
    rows = vcf.withColumn("gt", called).select("*", F.posexplode("alts").alias("k", "allele"))
    carried = rows.filter(F.exists("gt", lambda g: g == F.col("k") + 1) & (F.col("allele") != "*") & ~F.col("allele").startswith("<"))
    zyg = F.when(F.size("gt") == 1, "hemizygous").when(F.size(F.array_distinct("gt")) == 1, "hom_alt").otherwise("het")
    text = F.when((F.size("filter") == 0) | (F.array_join("filter", ",") == "PASS"), "PASS").otherwise(F.array_join("filter", ","))
    two = F.size(F.filter(F.array_distinct("gt"), lambda g: g > 0)) == 2
    return carried.select("contig", "pos", "ref", F.col("allele").alias("alt"), zyg.alias("zygosity"), text.alias("filter_text"), two.alias("has_partner"), F.col("sample")["PGT"].alias("pgt"), F.col("sample")["PID"].alias("pid"))


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated population counts, one row an alternative; ``.`` is NULL, misfit lists too."""
    raw = spark.read.schema("contig string, pos bigint, ref string, alt string, filter string, ac string, an bigint, af string").option("sep", "\t").option("nullValue", ".").csv(path)
    rows = raw.select("*", F.posexplode(F.split("alt", ",")).alias("k", "one"))
    pick = lambda c, t: F.get(F.split(c, ","), F.col("k")).try_cast(t)
    return rows.select("contig", "pos", "ref", F.col("one").alias("alt"), "filter", pick("ac", "bigint").alias("ac"), "an", pick("af", "double").alias("af"))


def read_edges(spark: SparkSession, path: str, score_min: int) -> DataFrame:
    """Space-separated edges with a header; low scores go at the scan."""
    raw = spark.read.schema("a string, b string, score int").option("sep", " ").option("header", True).csv(path)
    return raw.filter(F.col("score") >= score_min)


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in rows.columns if c not in (key, order)])


def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """Terms of an ontology: ``term, name, parents, alt_ids, obsolete, replaced_by``; a stanza is a row."""
    stanzas = spark.read.option("lineSep", "\n[").text(path).filter(F.col("value").startswith("Term]") | F.col("value").startswith("[Term]"))

    def every(key):
        return F.regexp_extract_all("value", F.lit(rf"(?m)^{key}: (\S+)"), F.lit(1))

    return stanzas.select(
        F.get(every("id"), F.lit(0)).alias("term"), F.regexp_extract("value", r"(?m)^name: (.*)$", 1).alias("name"), every("is_a").alias("parents"), every("alt_id").alias("alt_ids"),
        F.col("value").rlike(r"(?m)^is_obsolete: true").alias("obsolete"), F.get(every("replaced_by"), F.lit(0)).alias("replaced_by"),
    )


def read_associations(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Distinct (entity, term) of an association table, and how many negated rows it had."""
    raw = require(spark.read.option("sep", "\t").option("header", True).csv(path), ["subject", "object", "negated"])
    negated = F.lower(F.coalesce("negated", F.lit(""))) == "true"
    return raw.filter(~negated).select(F.col("subject").alias("entity"), F.col("object").alias("term")).distinct(), raw.filter(negated).count()


def read_zip_json(spark: SparkSession, path: str, schema: str, key: str = "results") -> DataFrame:
    """Records under ``key`` of the JSON files in zip archives, an archive a task at a time."""
    from pyspark.sql.types import _parse_datatype_string

    fields = [f.name for f in _parse_datatype_string(schema).fields]

    def rows(it):
        for pdf in it:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        found = json.loads(z.read(name)).get(key, [])
                        if found:
                            yield pd.DataFrame([{f: r.get(f) for f in fields} for r in found], columns=fields)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, schema)


def read_docx_tables(spark: SparkSession, path: str) -> DataFrame:
    """Cells of the tables in word-processor files: ``path, row, cells``."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def rows(it):
        for pdf in it:
            for name, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    root = ElementTree.fromstring(z.read("word/document.xml"))
                got = [["".join(t.text or "" for t in c.iter(f"{w}t")) for c in r.iter(f"{w}tc")] for r in root.iter(f"{w}tr")]
                if got:
                    yield pd.DataFrame({"path": name, "row": range(len(got)), "cells": got})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, "path string, row long, cells array<string>")


def read_seed(spark: SparkSession, path: str, columns: list[str], lists: list[str], key: str) -> DataFrame:
    """A curated table: ``#`` comments, exact header, ``;`` lists, no key twice."""
    raw = spark.read.option("sep", "\t").option("header", True).option("comment", "#").csv(path)
    if raw.columns != columns:
        raise ValueError(f"the header is {raw.columns}, not {columns}")
    if not raw.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{key} is listed twice")
    split = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    return raw.withColumns({c: split(F.col(c)) for c in lists})


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Literature records of a folder of cached JSON pages, one per key, lists lower-cased."""
    raw = spark.read.schema(RECORD).json(folder)
    low = lambda c: F.array_sort(F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), F.lower)))
    key = F.coalesce(F.nullif("pmid", F.lit("")), F.nullif("doi", F.lit("")), F.concat_ws(":", "source", "id"))
    rows = raw.select(
        key.alias("key"), "id", "source", "pmid", "doi", "title", F.col("journalTitle").alias("journal"), F.col("pubYear").try_cast("int").alias("year"), F.col("abstractText").alias("abstract"),
        low(F.col("pubTypeList.pubType")).alias("types"), low(F.col("meshHeadingList.meshHeading.descriptorName")).alias("terms"),
    )
    return rows.withColumn("retracted", F.array_contains("types", "retracted publication")).dropDuplicates(["key"])


def read_recorded(spark: SparkSession, status_path: str, base: str) -> DataFrame:
    """Tables of the channels that the status record calls complete; a directory is never globbed."""
    with open(status_path, encoding="utf-8") as f:
        status = json.load(f)
    tables = [spark.read.option("sep", "\t").option("header", True).csv(f"{base}/{n}.tsv").withColumn("channel", F.lit(n)) for n, s in sorted(status.items()) if s.get("status") == "complete"]
    if len(tables) < 2:
        raise ValueError("a consensus needs two complete channels")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return require(out, ["key"])


#: Fixed value: the form of a protein accession.
ACCESSION = r"^([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2})$"


def read_regions(spark: SparkSession, path: str, genes: list[str] | None = None) -> DataFrame:
    """``gene, contig, start, end`` of a four-column region table; a gene that is asked for and missing is an error."""
    raw = spark.read.schema("contig string, start bigint, end bigint, gene string").option("sep", "\t").csv(path)
    rows = raw.select("gene", bare_contig(F.col("contig")).alias("contig"), "start", "end")
    if genes is None:
        return rows
    wanted = spark.createDataFrame([(g,) for g in genes], "gene string")
    missing = [r["gene"] for r in wanted.join(rows.select("gene"), "gene", "left_anti").collect()]
    if missing:
        raise ValueError(f"no region is known for {sorted(missing)}")
    return rows.join(wanted.distinct(), "gene", "left_semi").select("gene", "contig", "start", "end")


def read_accessions(spark: SparkSession, path: str) -> DataFrame:
    """``accession, protein`` of an alias table: accessions of the protein archive, isoforms cut off, the first line of each wins."""
    raw = spark.read.schema("protein string, alias string, source string").option("sep", "\t").option("header", True).option("enforceSchema", True).csv(path)
    rows = raw.filter(F.contains("source", F.lit("UniProt"))).select(F.substring_index("alias", "-", 1).alias("accession"), "protein", F.monotonically_increasing_id().alias("line"))
    return first_wins(rows.filter(F.col("accession").rlike(ACCESSION)), "accession", "line")


def read_memberships(spark: SparkSession, path: str, accessions: DataFrame, species: str) -> DataFrame:
    """Distinct ``node, grp``: pathways of one species, by the proteins of their accessions."""
    raw = spark.read.schema("accession string, grp string, url string, name string, code string, species string").option("sep", "\t").csv(path)
    rows = raw.filter(F.col("species") == species).select(F.substring_index("accession", "-", 1).alias("accession"), "grp")
    return rows.join(accessions, "accession").select(F.col("protein").alias("node"), "grp").distinct()


def read_metadata(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A tab-separated table with a header, compressed or not, that must have the columns."""
    return require(spark.read.option("sep", "\t").option("header", True).csv(path), columns)


def read_identifier_map(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``key, code`` of a two-column mapping whose header names its sources."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    if not any("src" in c.lower() for c in raw.columns):
        raise ValueError(f"{path} is no mapping: its header is {raw.columns}")
    a, b = raw.columns[:2]
    rows = raw.select(F.col(f"`{a}`").alias("key"), F.col(f"`{b}`").alias("code"))
    return rows.filter("key <> '' AND code <> ''").distinct()


def archive_records(vcf: DataFrame) -> DataFrame:
    """Records of a variant archive, one an allele: place, gene, class, stars, review status as given.

    A status that the vocabulary lacks has NULL stars and keeps its text, so it can be counted.
    """
    info = F.col("info")
    rows = vcf.select("*", F.explode("alts").alias("alt"))
    return rows.select(
        bare_contig(F.col("contig")).alias("contig"), "pos", "ref", "alt", F.col("id").alias("rec"),
        F.substring_index(F.substring_index(info["GENEINFO"], "|", 1), ":", 1).alias("gene"),
        significance_class(F.coalesce(info["CLNSIG"], F.lit(""))).alias("class"), review_stars(info["CLNREVSTAT"]).alias("stars"), info["CLNREVSTAT"].alias("status"),
    )


def sha256(path: str) -> str:
    """Digest of a file, kept beside it with the size and time it was taken at."""
    stat, side = os.stat(path), f"{path}.sha256.json"
    tag = [stat.st_size, stat.st_mtime_ns]
    if os.path.exists(side):
        with open(side, encoding="utf-8") as f:
            held = json.load(f)
        if held["of"] == tag:
            return held["sha256"]
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            h.update(chunk)
    with open(f"{side}.tmp", "w", encoding="utf-8") as f:
        json.dump({"of": tag, "sha256": h.hexdigest()}, f)
    os.replace(f"{side}.tmp", side)
    return h.hexdigest()


def parts_of(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Files of a folder that any of Spark's stores holds, in order; none at all is an error."""
    found = sorted(r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").collect())
    if not found:
        raise ValueError(f"{folder} holds no {pattern}")
    return found


def provenance(path: str, origin: str, taken: str) -> dict:
    """Where a file comes from, its size and digest, kept beside it; a file that has changed since is an error."""
    record, side = {"origin": origin, "bytes": os.path.getsize(path), "sha256": sha256(path)}, f"{path}.origin.json"
    if os.path.exists(side):
        with open(side, encoding="utf-8") as f:
            held = json.load(f)
        if {k: held[k] for k in record} != record:
            raise ValueError(f"{path} is not the file that was taken from {held['origin']}")
        return held
    with open(f"{side}.{os.getpid()}.tmp", "w", encoding="utf-8") as f:
        json.dump(record | {"taken": taken}, f, sort_keys=True)
    os.replace(f"{side}.{os.getpid()}.tmp", side)
    return record | {"taken": taken}
