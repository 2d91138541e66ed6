import gzip
import io
import json
import random
import zipfile

from pyspark.sql import functions as F

from assaymill.operators import retrieval, supplements
from assaymill.sources import aliases, files, jsonl, matrix, office, repositories, snapshots, soft, tables


def frame(spark, content, path="a.csv"):
    return spark.createDataFrame([(path, content)], "path string, content string")


def lined(spark, content, path="a.csv", key="path"):
    return files.split_lines(spark.createDataFrame([(path, content)], f"{key} string, content string"), key)


def panel(spark, content):
    lines = lined(spark, content)
    return tables.panel_rows(lines, tables.profiles(lines))


def test_triage_import(spark, tmp_path):
    lines = ['{"pmc_id": "PMC1", "title": "first", "category": "review", "confidence": 0.9}', "", "not json", '{"title": "no id"}',
             '{"pmc_id": "PMC1", "title": "second", "category": "review"}', '{"pmc_id": "PMC2", "title": "two", "supplement_signal": true}']
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    rec = jsonl.read_triage(spark, str(tmp_path / "t.jsonl"))
    papers, results = jsonl.import_triage(rec)
    assert {(r["pmc_id"], r["title"]) for r in papers.collect()} == {("PMC1", "first"), ("PMC2", "two")}
    assert [(r["pmc_id"], r["category"], r["base_protocols"]) for r in results.collect()] == [("PMC1", "review", [])]
    again, _ = jsonl.import_triage(rec, papers)
    assert again.count() == 0


def test_files_and_archives(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    (tmp_path / ".hidden.txt").write_text("x")
    (tmp_path / "b.xyz").write_text("x")
    with gzip.open(tmp_path / "c.txt.gz", "wt") as f:
        f.write("zipped")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d/in.csv", "1")
        z.writestr("__MACOSX/in.csv", "1")
        z.writestr("d/.secret", "1")
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    listed = files.listing(spark, str(tmp_path))
    assert [r["name"] for r in files.usable(listed, ["txt", "xyz"]).orderBy("name").collect()] == ["a.txt", "b.xyz"]
    assert [r["name"] for r in files.usable(listed, ["txt"], max_bytes=2).collect()] == []
    texts = files.texts(spark, str(tmp_path), "*.txt*")
    assert "zipped" in {r["content"] for r in texts.collect()}
    got = files.archive_members(files.contents(spark, str(tmp_path), "*.zip")).collect()
    assert [(r["member"], r["name"]) for r in got] == [("d/in.csv", "in.csv")]


def test_supplement_members(spark):
    m = spark.createDataFrame([("P1", "named.csv"), ("P1", "x_MOESM1.pdf"), ("P1", "Article_supp.pdf"), ("P1", "fig.jpg"), ("P1", "other.pdf")],
                              "pmc_id string, name string")
    manifest = spark.createDataFrame([("P1", "named.csv")], "pmc_id string, filename string")
    assert sorted(r["name"] for r in files.supplement_members(m, manifest).collect()) == ["named.csv", "x_MOESM1.pdf"]


def test_count_table_delimiters(spark):
    for d in ("\t", ",", ";"):
        text = d.join(["id", "gene", '"s1"', "s2"]) + "\n" + d.join(["1", '"ALB"', "1.5", "x"]) + "\n" + d.join(["2", "FOO", "1", "2"]) + "\n" \
            + d.join(["3", "albumin", "7", "8"])
        rows = tables.count_cells(panel(spark, text)).collect()
        assert {(r["gene_symbol"], r["sample"], r["value"]) for r in rows} == {("ALB", "id", 3.0), ("ALB", "s1", 7.0), ("ALB", "s2", 8.0)}


def test_classify_and_deg(spark):
    deg = "Gene Symbol\tlog2 Fold Change\tp value\tpadj\nALB\t1.5\t0.1\t0.01\nFOO\t1\t1\t1\nOCT4\t-2\t0.2\tNA\n"
    p = tables.classify(tables.profiles(lined(spark, deg)))
    assert p.first()["kind"] == "deg_list"
    head = "gene\tlog2FC\tpadj\nALB\t1.5\t0.01\nOCT4\t-2\tNA\n"
    rows = {r["gene_symbol"]: (r["log2fc"], r["padj"]) for r in tables.deg_rows(panel(spark, head)).collect()}
    assert rows == {"ALB": (1.5, 0.01), "POU5F1": (-2.0, None)}
    kinds = {"gene,tpm\nA,1\n": "count_matrix", "gene,a,b,c,d\nA,1,2,3,4\n": "count_matrix", "pathway,x\nA,1\n": "pathway_table",
             "sample,x\nA,1\n": "sample_metadata", "a,b\n1,2\n": "other", "a\n1\n": "other"}
    for text, kind in kinds.items():
        assert tables.classify(tables.profiles(lined(spark, text))).first()["kind"] == kind, text


def test_expression_table_drops_annotation(spark):
    rows = tables.expression_cells(panel(spark, "gene,description,WT,KO\nALB,x,1,2\n")).collect()
    assert {(r["sample"], r["value"]) for r in rows} == {("WT", 1.0), ("KO", 2.0)}


def test_previews(spark):
    text = "Gene,Expression\nA|B,\nC,2\n"
    assert tables.preview_markdown(tables.parse(frame(spark, text))).first()["markdown"] == (
        "| Gene | Expression |\n| --- | --- |\n| A\\|B |  |\n| C | 2 |")
    df = spark.createDataFrame([(1, i, str(i)) for i in range(250)], "k int, i int, v string")
    whole, preview = (supplements.table_markdown(df, ["k"], ["i"], ["v"], limit).first()["markdown"] for limit in (None, 200))
    assert whole.count("\n") == 251 and whole.endswith("| 249 |") and preview.count("\n") == 201 and preview.endswith("| 199 |")


def test_series_matrix(spark):
    text = ('!Series_platform_id\t"GPL570"\n!Sample_title\t"t1"\t"t2"\n!Sample_geo_accession\t"GSM1"\t"GSM2"\n"ID_REF"\t"GSM1"\t"GSM2"\n'
            '"p1"\t1\t3\t99\n"p2"\t5\tNA\n"p3"\t0\t0\n!series_matrix_table_end\n"ALB"\t9\t9\n')
    f = lined(spark, text, "m")
    t = matrix.tables(f)
    assert t.frames.first()["platform"] == "GPL570" and t.body.count() == 0
    assert matrix.gene_cells(t).count() == 0
    ann = lined(spark, "#c\nID\tGene Symbol\nx\t---\np1\tFOO /// ALB\np2\talbumin\n", "GPL570", "platform")
    probes = matrix.probe_genes(ann)
    best = matrix.cells(retrieval.best_probe(matrix.probe_rows(matrix.tables(f, probes), probes)))
    assert {(r["probe"], r["sample"], r["value"]) for r in best.collect()} == {("p2", "GSM1", 5.0), ("p2", "GSM2", None)}
    assert {(r["gsm_id"], r["title"]) for r in matrix.sample_titles(f).collect()} == {("GSM1", "t1"), ("GSM2", "t2")}


def test_files_are_read_by_lines_in_many_splits(spark, tmp_path):
    rng = random.Random(3)
    named = ["ALB", "OCT4", "AFP"]
    body = [f'"{rng.choice(named) if i % 40 == 0 else f"p{i}"}"\t{i}\t{i + 0.5}' for i in range(600)]
    for name, blanks in (("a", 3), ("b", 0)):
        head = ['!Series_platform_id\t"GPL570"', *[""] * blanks, '"ID_REF"\t"GSM1"\t"GSM2"']
        (tmp_path / f"{name}.txt").write_text("\n".join([*head, *body, "!series_matrix_table_end", '"CYP3A4"\t9\t9']) + "\n")
    rows = [f"{rng.choice(named) if i % 30 == 0 else f'g{i}'},{i},{'' if i % 7 else 'x'}" for i in range(500)]
    (tmp_path / "c.csv").write_text("\n".join(["ALB,s1,s2", *rows]))  # a header that itself names a panel gene
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.lines(spark, str(tmp_path), "*.txt")
        assert lines.rdd.getNumPartitions() > 10
        whole = matrix.gene_cells(matrix.tables(files.split_lines(files.texts(spark, str(tmp_path), "*.txt"))))
        key = lambda df: sorted((r["path"][-5:], r["gene_symbol"], r["sample"], r["value"]) for r in df.collect())
        got = key(matrix.gene_cells(matrix.tables(lines)))
        want = {}
        for line in body:
            gene, a, b = line.replace('"', "").split("\t")
            if gene in named:
                want[{"OCT4": "POU5F1"}.get(gene, gene)] = (float(a), float(b))
        assert got == key(whole) == sorted((f"{f}.txt", g, s, v) for f in "ab" for g, vs in want.items() for s, v in zip(("GSM1", "GSM2"), vs))
        lines = files.lines(spark, str(tmp_path), "*.csv")
        found = tables.profiles(lines)
        p = found.first()
        assert (p["delimiter"], p["header"], p["n_rows"], p["filled"], p["odd"]) == (",", ["ALB", "s1", "s2"], 500, 500, 0)
        last = {{"OCT4": "POU5F1"}.get(g, g): float(v) for g, v, _ in (r.split(",") for r in rows) if g in named}
        cells = tables.count_cells(tables.panel_rows(lines, found)).collect()
        assert {r["gene_symbol"]: r["value"] for r in cells if r["sample"] == "s1"} == last
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_an_exported_matrix_comes_back(spark, tmp_path):
    from assaymill.operators import export
    a = spark.createDataFrame([("p1", "S 1", 1.5, None), ("p2", "S, 2", -2.0, 3.25)], "protocol_id string, stage_name string, ALB double, AFP double")
    b = spark.createDataFrame([(7.0, "p3", 8.0)], "SOX17 double, protocol_id string, ALB double")
    export.write_tsv(a.coalesce(1), str(tmp_path / "m" / "a"))
    export.write_tsv(b.coalesce(1), str(tmp_path / "m" / "b"))
    keys = ["protocol_id", "stage_name"]
    found = tables.integrated(spark, str(tmp_path / "m"), keys)
    wide = tables.aligned(found, keys, ["AFP", "ALB", "SOX17"])
    assert {tuple(r)[1:] for r in wide.collect()} == {("p1", "S 1", None, 1.5, None), ("p2", "S, 2", 3.25, -2.0, None), ("p3", None, None, 8.0, 7.0)}
    assert tables.integrated(spark, str(tmp_path / "none"), keys).count() == 0


def test_soft(spark):
    text = ("^SAMPLE = GSM1\n!Sample_title = a = b\n!Sample_characteristics_ch1 = cell: iPSC\n!Sample_characteristics_ch1 = bare\n"
            "!Sample_characteristics_ch1 = cell: ESC\n!Sample_relation = SRA: https://x?term=SRX12\n^SAMPLE = GSM2\n!Sample_title = z\n")
    rows = {r["gsm_id"]: r for r in soft.samples(spark.createDataFrame([("GSE1", text)], "accession string, soft string")).collect()}
    assert rows["GSM1"]["characteristics"] == {"cell": "ESC", "bare": "bare"} and rows["GSM1"]["sra_accession"] == "SRX12"
    assert rows["GSM1"]["sample_title"] == "a = b" and rows["GSM2"]["sra_accession"] == ""
    gone = spark.createDataFrame([("GSE9", "GSE9 could not be found")], "accession string, soft string")
    assert soft.series(gone).count() == 0


def test_office_files(spark):
    def pack(parts):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for n, x in parts.items():
                z.writestr(n, x)
        return bytearray(buf.getvalue())

    w = 'xmlns:w="http://w"'
    doc = (f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>Body</w:t></w:r></w:p>'
           "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a|b</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl></w:body></w:document>")
    slide = '<p:sld xmlns:p="http://p" xmlns:a="http://a"><p:txBody><a:p><a:r><a:t>Hi</a:t></a:r></a:p></p:txBody></p:sld>'
    book = '<workbook xmlns="http://x"><sheets><sheet name="Genes"/></sheets></workbook>'
    sheet = ('<worksheet xmlns="http://x"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>x</v></c></row><row><c r="B2"><v>2</v></c></row></sheetData></worksheet>')
    shared = '<sst xmlns="http://x"><si><t>Gene</t></si></sst>'
    df = spark.createDataFrame([
        ("a.docx", pack({"word/document.xml": doc})), ("b.pptx", pack({"ppt/slides/slide1.xml": slide})),
        ("c.xlsx", pack({"xl/workbook.xml": book, "xl/sharedStrings.xml": shared, "xl/worksheets/sheet1.xml": sheet})), ("d.docx", bytearray(b"junk"))],
        "path string, content binary")
    p = office.parts(df).cache()
    assert office.word_markdown(p).first()["text"] == "### Head\n\nBody\n\n| a\\|b |  |\n| --- | --- |"
    assert office.slides_markdown(p).first()["text"] == "### Slide 1\n\nHi"
    assert office.workbook_markdown(p).first()["text"] == "### Sheet: Genes\n\n| Gene |  | x |\n| --- | --- | --- |\n|  | 2 |  |"


def test_converter_is_optional(spark):
    df = spark.createDataFrame([("a.pdf", bytearray(b"x"))], "path string, content binary")
    assert office.convert(df).count() == 0
    assert office.convert(df, lambda b: "y" * 101).count() == 1
    assert office.convert(df, lambda b: "y" * 100).count() == 0


def test_run_tables(spark):
    body = json.dumps([{"sample_alias": "a", "instrument_model": "X", "library_strategy": "RNA-Seq", "read_count": "5"},
                       {"sample_alias": "a", "instrument_model": "", "library_strategy": "RNA-Seq", "read_count": "bad"}])
    r = repositories.aggregate_runs(repositories.runs_from_json(spark.createDataFrame([("P", body)], "accession string, answer string"))).first()
    assert (r["sample_count"], r["platform"], r["data_type"], r["total_reads"]) == (1, "X", "bulk_rnaseq", 5)
    csv = "Run,SampleName,Model,LibraryStrategy\nr1,s1,M,ChIP-Seq\nr2,s2,M,ChIP-Seq\n"
    r = repositories.aggregate_runs(repositories.runs_from_csv(spark.createDataFrame([("P", csv)], "accession string, answer string"))).first()
    assert (r["sample_count"], r["platform"], r["data_type"]) == (2, "M", "chip_seq")


def test_fetch_survives_failures(spark):
    def transport(k):
        if k == "bad":
            raise OSError("down")
        return k.upper()
    df = spark.createDataFrame([("a",), ("bad",)], "k string")
    assert {(r["k"], r["answer"]) for r in repositories.fetch(df, "k", transport).collect()} == {("a", "A"), ("bad", None)}


def test_study_and_links(spark):
    study = json.dumps({"title": "T", "section": {"subsections": [{"type": "Samples", "links": ["a", "b"]}]}})
    r = repositories.study_from_json(spark.createDataFrame([("E", study)], "accession string, answer string")).first()
    assert (r["project_title"], r["sample_count"]) == ("T", 2)
    xml = "<DocumentSummary><Accession>GSE10001</Accession><title>t</title></DocumentSummary> GSE20002 GSM30003"
    got = {(r["accession"], r["title"]) for r in repositories.linked_series(spark.createDataFrame([(1, xml)], "paper_id long, answer string")).collect()}
    assert got == {("GSE10001", "t"), ("GSE20002", "")}


def test_aliases(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"growth_factors": {"HGF": ["hgf"]}, "small_molecules": {}, "markers": {}}))
    assert aliases.load_alias_tables(str(tmp_path / "a.json"))["growth_factor"] == {"HGF": ["hgf"]}
    rule = aliases.load_alias_tables(names={"growth_factor": ["BMP4", "TGFα"]})["growth_factor"]
    assert {"bmp4", "bmp-4"} <= set(rule["BMP4"]) and {"tgfα", "tgfa", "tgfalpha"} <= set(rule["TGFα"])
    t = aliases.entry_terms(spark.createDataFrame([("D1", "MH = Factor\nENTRY = Other|x|y\nEntry Term = third\nnope")], "uid string, answer string"))
    names = spark.createDataFrame([("growth_factor", "F1", "D1")], "category string, canonical string, uid string")
    manual = spark.createDataFrame([("growth_factor", "F1", "f-1"), ("marker", "M", "m2")], "category string, canonical string, alias string")
    got = {r["canonical"]: r["aliases"] for r in aliases.build_aliases(t, names, manual).collect()}
    assert got == {"F1": ["f-1", "f1", "factor", "other", "third"], "M": ["m", "m2"]}


def test_snapshots(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert snapshots.latest(spark, folder) is None
    snapshots.write_next(spark.range(2), folder)
    snapshots.write_next(spark.range(3), folder)
    (tmp_path / "t" / "v9").mkdir()
    assert snapshots.latest(spark, folder).count() == 3
    aligned = snapshots.latest(spark, folder, "extra string, id bigint")
    assert aligned.columns == ["extra", "id"] and aligned.where(F.col("extra").isNotNull()).count() == 0
