import pytest
from pyspark.sql import functions as F

from assaymill.operators import discovery, documents
from assaymill.sources.xml import shred

PAPER = """<?xml version="1.0"?>
<article article-type="research-article" xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta>
<article-id pub-id-type="pmcid">PMC77</article-id><article-id pub-id-type="pmid">5</article-id>
<article-id pub-id-type="doi">10.1/a</article-id><title-group><article-title>A <i>title</i></article-title></title-group>
<abstract></abstract><abstract><sec><title>Aim</title><p>To <b>see</b>.</p></sec></abstract></article-meta></front>
<body><p>Loose text.</p><sec><title>Methods</title><p>Cells in <italic>vivo</italic> H<sub>2</sub>O x<sup>2</sup> <xref>[1]</xref>.</p>
<sec><title>Deep</title><p>Inner.</p></sec></sec><sec><title>Results</title><p>R1</p>
<table-wrap><label>Table 1</label><caption><title>Cap</title><p>More</p></caption><table><thead><tr><th>A</th><th>B</th><th>C</th></tr></thead>
<tbody><tr><td>1</td><td>x|y</td></tr></tbody></table></table-wrap>
<fig><label>Fig 1</label><caption><p>Look.</p></caption></fig></sec><sec><title>Results</title><p>R2</p></sec>
<sec sec-type="data-availability"><title>Data</title><p>Series GSE11111 is here.</p></sec>
<sec><title>Talk</title><p>We downloaded from GEO the set GSE22222.</p></sec></body>
<back><ref-list><ref id="b1"><label>[1].</label><element-citation><person-group><name><surname>Si-Tayeb</surname></name></person-group>
<article-title>Old</article-title><year>2010</year><pub-id pub-id-type="doi">10.2/b</pub-id></element-citation></ref>
<ref><label>2</label><mixed-citation><name><surname>Lone</surname></name><year>2011</year> GSE33333</mixed-citation></ref>
<ref><label>3</label><mixed-citation>No ids</mixed-citation></ref></ref-list>
<sec><title>Results</title><p>Back wins</p></sec>
<supplementary-material xlink:href="x/y/mmc1.xlsx"><label>S1</label><caption><p>Table of all</p></caption></supplementary-material>
<supplementary-material><media xlink:href="pic.PNG"/></supplementary-material></back></article>"""


@pytest.fixture(scope="module")
def shredded(spark):
    df = spark.createDataFrame([(1, "d/PMC77.xml", PAPER), (2, "d/bad.xml", "<article><oops"), (3, "d/none.xml", "<article/>")],
                               "paper_id long, path string, xml string")
    return shred(df).cache()


def test_malformed_markup_gives_nulls(shredded):
    assert shredded.where("nodes IS NULL").select("paper_id").first()[0] == 2


def test_metadata(shredded):
    rows = documents.metadata(shredded).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["pmc_id"], r["pmid"], r["doi"], r["title"], r["article_type"]) == ("PMC77", "5", "10.1/a", "A title", "research-article")
    assert r["abstract"] == "Aim\nTo see."


def test_sections(shredded):
    r = documents.sections(shredded).first()
    secs = {s["title"]: s["text"] for s in r["sections"]}
    assert list(secs) == ["Methods", "Results", "Data", "Talk", "Body"]
    assert r["abstract"] == "**Aim**\nTo **see**." and r["has_methods"] and not r["has_supplement_inline"] and r["tables_found"] == 1
    assert secs["Methods"] == "\n## Methods\n\nCells in *vivo* H_2O x^2 [1].\n\n\n### Deep\n\nInner.\n"
    assert secs["Results"] == "\n## Results\n\nBack wins\n"
    assert secs["Body"] == "\nLoose text."


def test_table_and_figure(spark):
    xml = PAPER.replace("<sec><title>Results</title><p>Back wins</p></sec>", "")
    r = documents.sections(shred(spark.createDataFrame([("a.xml", xml)], "path string, xml string"))).first()
    text = {s["title"]: s["text"] for s in r["sections"]}["Results"]
    assert "\n**Table 1** Cap\n" in text and "\n**Fig 1** Look.\n" in text
    assert "| A | B | C |\n| --- | --- | --- |\n| 1 | x\\|y |  |" in text
    assert text.endswith("\n\n## Results\n\nR2\n")


def test_budget_prefers_methods(spark):
    secs = [("Introduction", "i" * 5000), ("Discussion", "d" * 5000), ("Methods", "m" * 5000), ("Results", "r" * 5000)]
    df = spark.createDataFrame([("T", "abs", secs)], "title string, abstract string, sections array<struct<title:string,text:string>>")
    text = documents.with_budgeted_text(df, 10_000).first()["full_text"]
    assert "m" * 5000 in text and text.index("## Methods") < text.index("## Results")
    assert "truncated" in text and "## Discussion" not in text and "## Introduction" not in text
    assert len(text) <= 10_000


def test_references(shredded):
    rows = [r.asDict() for r in documents.references(shredded).orderBy("ref_no").collect()]
    assert [(r["doi"], r["first_author_surname"], r["year"], r["label"]) for r in rows] == [
        ("10.2/b", "Si-Tayeb", "2010", "1"), (None, "Lone", "2011", "2")]
    assert rows[0]["title"] == "Old"


def test_accession_contexts(shredded):
    got = {r["accession"]: r["context"] for r in discovery.mine_markup(shredded).collect()}
    assert got == {"GSE11111": "own_data", "GSE22222": "referenced", "GSE33333": "referenced"}


def test_manifest_skips_images(shredded):
    rows = documents.supplement_manifest(shredded).collect()
    assert [(r["filename"], r["extension"], r["label"], r["caption"]) for r in rows] == [("mmc1.xlsx", ".xlsx", "S1", "Table of all")]


def test_article_set(spark):
    raw = ('<!DOCTYPE x><pmc-articleset><article><front><article-meta><article-id pub-id-type="pmcid">PMC12.1</article-id></article-meta></front>'
           '</article><article a="b"><article-id pub-id-type="pmcaid">34</article-id></article><article/></pmc-articleset>')
    df = spark.createDataFrame([(raw,)], "raw string")
    assert sorted(r["pmc_id"] for r in documents.split_article_set(df).collect()) == ["12", "34"]


def test_hits_merge(spark):
    hits = spark.createDataFrame([
        (1, "GSE1", "ambiguous", "xml", "a", 0), (1, "GSE1", "own_data", "elink", "b", 0), (1, "GSE2", "referenced", "xml", "c", 1)],
        "paper_id long, accession string, context string, source string, surrounding_text string, pos int")
    got = {r["accession"]: (r["context"], r["source"], r["surrounding_text"]) for r in discovery.merge_hits(hits).collect()}
    assert got == {"GSE1": ("own_data", "xml+elink", "b"), "GSE2": ("referenced", "xml", "c")}
    scored = {r["gse_id"]: r["confidence"] for r in discovery.score_hits(discovery.merge_hits(hits)).collect()}
    assert scored == {"GSE1": 0.9, "GSE2": 0.6}
    assert {r["geo_status"] for r in discovery.geo_status(
        spark.createDataFrame([(1, None), (2, None)], "id long, geo_status string"), discovery.score_hits(discovery.merge_hits(hits))).collect()} == {
        "linked", "checked_none"}


def test_readout_summary_has_every_part(spark):
    from assaymill.operators import readout
    from assaymill.plans import adapters
    sf = "/root/testdata/sf0.001"
    tables = readout.analyze(adapters.values(spark, sf), adapters.papers(spark, sf), adapters.protocols(spark, sf))
    assert set(tables) == {"aggregate", "trajectories", "ranking", "timepoints", "heatmap", "profile", "summary"}
    rows = tables["summary"].collect()
    assert {r["part"] for r in rows} == {0, 1, 2, 3} and all(r["line"] for r in rows)
