"""Readers, sinks, streams and the runner on invented files."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestone.functions import alleles
from lodestone.plans import reports, runner
from lodestone.sources import readers, sinks, submission
from lodestone.streaming import events

HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMPLE\n"


def _vcf(tmp_path):
    rows = [
        (1100, "C", "T", "PASS", "0/1", "12,10"), (1200, "G", "A", "PASS", "1/1", "0,20"), (1300, "A", "T,G", "PASS", "1/2", "0,9,9"), (1400, "A", "C", "PASS", "0/0", "20,0"),
        (1500, "A", "C", "PASS", "./.", ".,."), (1600, "T", "C", "FS60", "0/1", "9,9"), (1700, "T", "C,*", "PASS", "1/2", "0,9,9"),
    ]
    text = HEAD + "".join(f"1\t{p}\t.\t{r}\t{a}\t.\t{f}\tDP=20;DB;X=a=b\tGT:AD\t{g}:{d}\n" for p, r, a, f, g, d in rows)
    path = tmp_path / "a.vcf"
    path.write_text(text)
    return str(path)


def test_variant_text(spark, tmp_path):
    vcf = readers.read_vcf(spark, _vcf(tmp_path), 2)
    assert vcf.count() == 7 and vcf.filter("pos = 1100").first().info == {"DP": "20", "X": "a=b"}
    sites = {r.pos: r for r in readers.allele_sites(vcf).collect()}
    assert sorted(sites) == [1100, 1200, 1400, 1600] and sites[1100].het and not sites[1200].het and not sites[1600].passing
    got = {(r.pos, r.alt): r for r in readers.alleles(vcf).collect()}
    assert set(got) == {(1100, "T"), (1200, "A"), (1300, "T"), (1300, "G"), (1600, "C"), (1700, "C")}
    assert got[1200, "A"].zygosity == "hom_alt" and got[1300, "T"].has_partner and got[1600, "C"].filter_text == "FS60"


def test_population_and_edges(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("1\t5\tC\tT,G\tPASS\t3,4\t100\t0.03,.\n1\t6\tA\tC,G\tPASS\t3\t.\t.\n")
    got = sorted((tuple(r) for r in readers.read_population(spark, str(tmp_path / "p.tsv")).collect()), key=str)
    assert got == [("1", 5, "C", "G", "PASS", 4, 100, None), ("1", 5, "C", "T", "PASS", 3, 100, 0.03), ("1", 6, "A", "C", "PASS", 3, None, None), ("1", 6, "A", "G", "PASS", None, None, None)]
    (tmp_path / "e.txt").write_text("a b score\nP0 P1 900\nP1 P2 100\n")
    assert [tuple(r) for r in readers.read_edges(spark, str(tmp_path / "e.txt"), 400).collect()] == [("P0", "P1", 900)]


def test_ontology_and_associations(spark, tmp_path):
    (tmp_path / "o.obo").write_text("format-version: 1.2\n\n[Term]\nid: A:1\nname: root\n\n[Term]\nid: A:2\nname: child\nis_a: A:1 ! root\nalt_id: A:9\n\n[Term]\nid: A:3\nis_obsolete: true\nreplaced_by: A:2\n\n[Typedef]\nid: part_of\n")
    got = {r.term: r for r in readers.read_obo(spark, str(tmp_path / "o.obo")).collect()}
    assert set(got) == {"A:1", "A:2", "A:3"} and got["A:2"].parents == ["A:1"] and got["A:3"].replaced_by == "A:2" and got["A:3"].obsolete
    (tmp_path / "as.tsv").write_text("subject\tobject\tnegated\nd1\tA:1\t\nd1\tA:1\tfalse\nd2\tA:2\tTrue\n")
    rows, negated = readers.read_associations(spark, str(tmp_path / "as.tsv"))
    assert [tuple(r) for r in rows.collect()] == [("d1", "A:1")] and negated == 1
    (tmp_path / "bad.tsv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        readers.read_associations(spark, str(tmp_path / "bad.tsv"))


def test_archives_of_records(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "l.zip", "w") as z:
        z.writestr("a.json", json.dumps({"results": [{"id": "1", "name": "x"}, {"id": "2"}]}))
    assert sorted(tuple(r) for r in readers.read_zip_json(spark, str(tmp_path / "l.zip"), "id string, name string").na.fill("-").collect()) == [("1", "x"), ("2", "-")]
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    doc = io.BytesIO()
    with zipfile.ZipFile(doc, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:document>")
    (tmp_path / "t.docx").write_bytes(doc.getvalue())
    assert readers.read_docx_tables(spark, str(tmp_path / "t.docx")).first().cells == ["a", "b"]


def test_seed_and_records(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("# note\nname\taliases\nx\ta; b;\ny\t\n")
    got = {r.name: r.aliases for r in readers.read_seed(spark, str(tmp_path / "s.tsv"), ["name", "aliases"], ["aliases"], "name").collect()}
    assert got == {"x": ["a", "b"], "y": []}
    (tmp_path / "d.tsv").write_text("name\taliases\nx\t\nx\t\n")
    with pytest.raises(ValueError):
        readers.read_seed(spark, str(tmp_path / "d.tsv"), ["name", "aliases"], ["aliases"], "name")
    folder = tmp_path / "json"
    folder.mkdir()
    page = [{"id": "1", "source": "MED", "pmid": "7", "title": "T", "pubYear": "2001", "pubTypeList": {"pubType": ["Review", "Retracted Publication"]}}, {"id": "1", "source": "MED", "pmid": "7"}, {"id": "9", "source": "PPR"}]
    (folder / "p.json").write_text("\n".join(map(json.dumps, page)))
    got = {r.key: r for r in readers.read_records(spark, str(folder)).collect()}
    assert set(got) == {"7", "PPR:9"}


def test_crosswalk_tables(spark, tmp_path):
    (tmp_path / "g.bed").write_text("chr1\t10\t20\tG1\nchr2\t5\t9\tG2\n")
    assert [tuple(r) for r in readers.read_regions(spark, str(tmp_path / "g.bed"), ["G2"]).collect()] == [("G2", "2", 5, 9)]
    with pytest.raises(ValueError, match="G9"):
        readers.read_regions(spark, str(tmp_path / "g.bed"), ["G1", "G9"])
    (tmp_path / "al.tsv").write_text("#protein\talias\tsource\nP0\tP12345-2\tEnsembl_UniProt\nP1\tP12345\tUniProt_AC\nP2\tnope\tUniProt_AC\nP3\tQ9Y6K9\tOther\n")
    acc = readers.read_accessions(spark, str(tmp_path / "al.tsv"))
    assert [tuple(r) for r in acc.collect()] == [("P12345", "P0")]
    (tmp_path / "re.tsv").write_text("P12345-1\tR1\tu\tn\tIEA\tHomo sapiens\nP12345\tR1\tu\tn\tIEA\tHomo sapiens\nP12345\tR2\tu\tn\tIEA\tMus musculus\n")
    assert [tuple(r) for r in readers.read_memberships(spark, str(tmp_path / "re.tsv"), acc, "Homo sapiens").collect()] == [("P0", "R1")]
    (tmp_path / "m.tsv").write_text("From src:1\tTo src:14\nC1\tU1\nC1\tU2\nC1\tU2\n\tU3\n")
    assert sorted(tuple(r) for r in readers.read_identifier_map(spark, str(tmp_path / "m.tsv")).collect()) == [("C1", "U1"), ("C1", "U2")]
    for read in (lambda p: readers.read_identifier_map(spark, p), lambda p: readers.read_metadata(spark, p, ["sig_id"])):
        with pytest.raises(ValueError):
            read(str(tmp_path / "g.bed"))


def test_archive_records(spark, tmp_path):
    line = "1\t5\t77\tC\tT\t.\t.\tCLNSIG=Pathogenic/Likely_pathogenic;CLNREVSTAT={};GENEINFO=G1:12|G2:13\n"
    (tmp_path / "c.vcf").write_text("##x\n#CHROM\n" + line.format("reviewed_by_expert_panel") + line.format("brand_new"))
    got = sorted((r.gene, r["class"], r.stars, r.status) for r in readers.archive_records(readers.read_vcf(spark, str(tmp_path / "c.vcf"))).na.fill(-1).collect())
    assert got == [("G1", "pathogenic", -1, "brand_new"), ("G1", "pathogenic", 3, "reviewed_by_expert_panel")]


def test_submission_files(spark, tmp_path):
    head = ["proband_id", "chrom", "epcr"]

    def codes(raw):
        (tmp_path / "s.csv").write_bytes(raw)
        return sorted((r.row, r.code) for r in submission.file_violations(spark, str(tmp_path / "s.csv"), head, 2).collect())

    assert codes(b"proband_id,chrom,epcr\np,chr1,0.5\n") == []
    assert codes(b"") == [(0, "empty")] and codes(b"\xff\xfe") == [(0, "encoding")]
    assert codes(b"\xef\xbb\xbfchrom,proband_id,epcr\n") == [(0, "byte_order_mark"), (0, "header_order"), (0, "no_rows")]
    assert codes(b"proband_id,chrom,x\na,chr1,1,\nb,chr1,1\n,chr1,2\n") == [(0, "header_missing"), (0, "header_unexpected"), (0, "several_ids"), (0, "too_many_rows"), (1, "width"), (3, "no_id")]
    rows = spark.createDataFrame([(1, "chr1", "5", "A", "T"), (2, "1", "-5", "A", ""), (3, None, " ", "", None)], "row long, contig string, pos string, ref string, alt string")
    assert sorted((r.row, r.code) for r in submission.allele_violations(rows).collect()) == [(2, "not_positive"), (2, "partly_filled"), (2, "prefix"), (3, "missing_allele")]
    built = spark.createDataFrame([("G", 1, 2, 0.4), ("G", 1, 3, 0.9), ("G", 2, 3, 0.1)], "gene string, a_id long, b_id long, epcr double")
    assert [(r.row, r.b_id) for r in submission.ranked_rows(built).collect()] == [(1, 3), (2, 2)]
    with pytest.raises(ValueError):
        submission.ranked_rows(built.union(built.selectExpr("'H'", "a_id", "b_id", "epcr")))


def test_recorded_tables_only(spark, tmp_path):
    for n in ("a", "b", "stale"):
        (tmp_path / f"{n}.tsv").write_text("key\trank\nk1\t1\n")
    status = tmp_path / "status.json"
    status.write_text(json.dumps({"a": {"status": "complete"}, "b": {"status": "complete"}, "stale": {"status": "failed"}}))
    assert {r.channel for r in readers.read_recorded(spark, str(status), str(tmp_path)).collect()} == {"a", "b"}
    status.write_text(json.dumps({"a": {"status": "complete"}}))
    with pytest.raises(ValueError):
        readers.read_recorded(spark, str(status), str(tmp_path))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ("s", 2))], "id int, note string, d struct<name:string,secret:int>")
    assert sinks.withheld_keys(df, {"secret"}) == ["d.secret"] and sinks.withheld_keys(sinks.strip_withheld(df, {"secret"}), {"secret"}) == []
    with pytest.raises(ValueError):
        sinks.publishable(df, ["id", "nothing"])
    sinks.write_tsv(df.select("id", "note"), str(tmp_path / "t"), ["id"])
    assert next(tmp_path.glob("t/part*")).read_text() == "id\tnote\n1\t\n"
    with pytest.raises(ValueError):
        sinks.write_tsv(spark.createDataFrame([("rs123456",)], "x string"), str(tmp_path / "u"), ["x"])
    (tmp_path / "f").write_bytes(b"abc")
    assert readers.sha256(str(tmp_path / "f")) == readers.sha256(str(tmp_path / "f")) == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_runner(spark, tmp_path):
    channels = {"a": lambda s, c: s.range(3), "b": lambda s, c: s.range(0), "c": lambda s, c: 1 / 0, "d": lambda s, c: s.range(1)}
    status = runner.run_channels(spark, channels, {"a": True, "b": True, "c": True, "d": False}, {}, str(tmp_path / "ch"))
    assert [status[k]["status"] for k in "abcd"] == ["complete", "failed", "failed", "disabled"] and status["a"]["rows"] == 3
    with pytest.raises(ValueError):
        runner.run_channels(spark, channels, {"a": True}, {}, str(tmp_path / "ch"))
    manifest, ran = str(tmp_path / "m.json"), []
    layers = {"one": lambda s, c: ran.append(1), "two": lambda s, c: 1 / c["zero"]}
    with pytest.raises(ZeroDivisionError):
        runner.run_layers(spark, layers, {"zero": 0}, manifest)
    assert json.load(open(manifest))["layers"]["two"]["status"] == "failed"
    done = runner.run_layers(spark, {"one": layers["one"], "two": lambda s, c: {"rows": 2}}, {}, manifest, resume=True)
    assert ran == [1] and done["layers"]["two"]["rows"] == 2
    with pytest.raises(ValueError):
        runner.check_config({"x": 1}, ["y"], ["x", "y"])
    assert runner.config_digest({"a": 1, "paths": "/x"}) == runner.config_digest({"paths": "/y", "a": 1})


def test_streams(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src = src.select(*[F.col(c).cast(t) for c, t in (("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string"))])
    src.unionAll(src).coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(df, name, mode):
        q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return spark.table(name)

    stream = events.read_events(spark, str(tmp_path / "in"))
    got = run(events.tumbling(events.distinct_events(stream, "30 days"), "1 hour", None), "tumbled", "append")
    assert got.count() >= 0
    whole = run(events.tumbling(stream, "1 hour", "30 days"), "whole", "complete")
    assert whole.agg(F.sum("n")).first()[0] == 2 * src.count()
    batch = src.groupBy(F.window("ts", "1 hour"), "event_type").count().count()
    assert whole.count() == batch
    assert run(events.sessions(stream, "10 minutes", "1 hour"), "sessions", "append").count() >= 0


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, "<b>"), (2, None, None)], "id int, x double, note string")
    assert reports.field_contract(df, ["id", "z"], True) == {"satisfied": ["id"], "outstanding": ["z"]}
    assert reports.field_contract(df, ["id", "z"], False)["outstanding"] == ["id", "z"]
    got = {r.claim: (r.found, r.holds) for r in reports.claims(spark, {"rows": (df, "count(*)", 2), "sum": (df, "sum(id)", 4), "none": (df.limit(0), "sum(id)", 0)}).collect()}
    assert got == {"rows": (2.0, True), "sum": (3.0, False), "none": (None, False)}
    assert [r.x for r in reports.formatted(df, {"x": 4}).orderBy("id").collect()] == ["0.5000", None]
    page = reports.html_table(df, ["id"])
    assert page == "<table><tr><th>id</th><th>x</th><th>note</th></tr><tr><td>1</td><td>0.5</td><td>&lt;b&gt;</td></tr><tr><td>2</td><td></td><td></td></tr></table>"
    with pytest.raises(ValueError):
        reports.html_table(df, ["id"], 1)
    with pytest.raises(ValueError):
        reports.figures(spark, "", ["no_such_query"])
    df.write.parquet(str(tmp_path / "t"))
    assert len(readers.parts_of(spark, str(tmp_path / "t"))) >= 1
    (tmp_path / "empty").mkdir()
    for broken in (lambda: readers.parts_of(spark, str(tmp_path / "empty")), lambda: reports.artifacts(str(tmp_path / "empty"))):
        with pytest.raises(ValueError):
            broken()
    assert reports.artifacts(str(tmp_path)) == ["empty", "t"]
    (tmp_path / "status.json").write_text(json.dumps({"t": {"status": "complete"}, "gone": {"status": "failed"}}))
    assert reports.artifacts(str(tmp_path)) == ["t"]
    (tmp_path / "f").write_bytes(b"abc")
    first = readers.provenance(str(tmp_path / "f"), "https://example.org/f", "2026-01-01")
    assert readers.provenance(str(tmp_path / "f"), "https://example.org/f", "2027-01-01") == first and first["bytes"] == 3
    (tmp_path / "f").write_bytes(b"abcd")
    with pytest.raises(ValueError):
        readers.provenance(str(tmp_path / "f"), "https://example.org/f", "2026-01-01")
    names = spark.createDataFrame([("chr1",), ("2",)], "c string").select(alleles.prefixed_contig(F.col("c")).alias("a"), alleles.remote_contig(F.col("c"), False).alias("b")).collect()
    assert [tuple(r) for r in names] == [("chr1", "1"), ("chr2", "2")]
