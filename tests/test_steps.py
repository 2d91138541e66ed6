import json

from assaymill import steps
from assaymill.sources import snapshots

PAPER = """<article><front><article-meta><article-id pub-id-type="pmcid">{id}</article-id><title-group><article-title>T {id}</article-title></title-group>
<abstract><p>abs</p></abstract></article-meta></front><body><sec><title>Methods</title><p>HGF was used. Data GSE12345 were deposited in GEO.</p></sec></body>
<back><ref-list><ref><element-citation><pub-id pub-id-type="doi">{cites}</pub-id></element-citation></ref></ref-list></back></article>"""


def test_run_resume_and_stop(spark, tmp_path):
    root, xml = tmp_path / "tables", tmp_path / "xml" / "PMC1"
    xml.mkdir(parents=True)
    for pid, cites in (("PMC1", "10.1/2"), ("PMC2", "10.1/none")):
        (xml / f"{pid}.xml").write_text(PAPER.format(id=pid, cites=cites))
    (tmp_path / "t.jsonl").write_text("\n".join(json.dumps(
        {"pmc_id": p, "doi": d, "title": p, "category": "primary_protocol", "confidence": 0.9}) for p, d in (("PMC1", "10.1/1"), ("PMC2", "10.1/2"))))
    listing = spark.createDataFrame([(p, f"{xml}/{p}.xml") for p in ("PMC1", "PMC2")], "pmc_id string, xml_path string")
    options = {"triage_log": str(tmp_path / "t.jsonl"), "xml_folder": str(tmp_path / "xml"), "listing": listing}

    def only(n):
        return steps.run(spark, str(root), options, only=n)

    assert only(1) == ["bootstrap"] and only(2) == ["convert_text"] and only(5) == ["order_papers"]
    t = steps.load(spark, str(root))
    first = {r["pmc_id"]: r for r in t["papers"].collect()}
    assert first["PMC2"]["processing_priority"] < first["PMC1"]["processing_priority"]
    assert all(r["parsed_text_path"] for r in first.values()) and t["paper_texts"].count() == 2
    assert t["triage_results"].count() == 2
    # A second run finds nothing new.
    only(1), only(2)
    t = steps.load(spark, str(root))
    assert t["papers"].count() == 2 and t["paper_texts"].count() == 2
    # Discovery takes completed papers only.
    from assaymill.operators import upserts
    from pyspark.sql import functions as F
    done = t["papers"].select("id", F.lit("completed").alias("extraction_status"))
    snapshots.commit(spark, str(root), {"papers": upserts.patch(t["papers"], done, "id", ["extraction_status"])})
    assert only(6) == ["discover_series"] and only(6.5) == ["ground_accessions"]
    t = steps.load(spark, str(root))
    assert {(r["gse_id"], r["context"]) for r in t["geo_accessions"].collect()} == {("GSE12345", "own_data")}
    assert {r["geo_status"] for r in t["papers"].collect()} == {"linked"}
    assert steps.run(spark, str(root), options, only=99) == []
    # Step 15 lacks its folder option: the run stops before step 16.
    assert steps.run(spark, str(root), options, start=15) == []


LONG = """<article><front><article-meta><article-id pub-id-type="pmcid">PMC1</article-id><title-group><article-title>T</article-title></title-group></article-meta></front>
<body><sec><title>Results</title><p>{filler}</p></sec><sec><title>Discussion</title><p>As in GSE12345, bFGF was used.</p></sec></body></article>"""


def test_grounding_reads_whole_papers_and_supplements(spark, tmp_path):
    from pyspark.sql import functions as F

    from assaymill import schemas
    root, folder = tmp_path / "tables", tmp_path / "xml"
    folder.mkdir()
    (folder / "PMC1.xml").write_text(LONG.format(filler="word " * 30_000))
    (tmp_path / "supp" / "PMC1_supp").mkdir(parents=True)
    (tmp_path / "supp" / "PMC1_supp" / "s1.txt").write_text("Deposited as GSE777; also CHIR-99021.")
    papers = spark.createDataFrame([(1, "PMC1", "primary_protocol", "x", "completed")], "id bigint, pmc_id string, triage_category string, xml_path string, extraction_status string")
    accessions = spark.createDataFrame([(i, 1, g) for i, g in enumerate(["GSE12345", "GSE777", "GSE999"])], "id bigint, paper_id bigint, gse_id string")
    protocols = spark.range(1).select(F.lit(5).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("paper_id"), F.from_json(F.lit(
        '[{"stage_name":"S1","growth_factors":[{"name":"FGF2"},{"name":"EGF"}],"small_molecules":[{"name":"CHIR99021"}],"stage_markers":[]}]'), schemas.STAGES).alias("stages"))
    snapshots.commit(spark, str(root), {n: snapshots.align(df, schemas.TABLES[n]) for n, df in
                                        (("papers", papers), ("geo_accessions", accessions), ("protocols", protocols))})
    options = {"xml_folder": str(folder), "supplement_folder": str(tmp_path / "supp")}
    for n in (2, 4, 6.5, 8):
        assert steps.run(spark, str(root), options, only=n), n
    t = steps.load(spark, str(root))
    assert len(t["paper_texts"].first()["text"]) > 150_000
    assert {r["gse_id"] for r in t["geo_accessions"].collect()} == {"GSE12345", "GSE777"}
    s = t["protocols"].first()["stages"][0]
    assert [g["name"] for g in s["growth_factors"]] == ["FGF2"] and [g["name"] for g in s["small_molecules"]] == ["CHIR99021"]


def test_a_commit_shows_all_of_a_step_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    snapshots.commit(spark, root, {"a": spark.range(1), "b": spark.range(1)})
    snapshots.write_next(spark.range(9), f"{root}/a")  # a step that died before its commit
    now = snapshots.committed(spark, root)
    assert [snapshots.at_commit(spark, root, now, n).count() for n in ("a", "b")] == [1, 1]
    snapshots.commit(spark, root, {"b": spark.range(2)})
    now = snapshots.committed(spark, root)
    assert [snapshots.at_commit(spark, root, now, n).count() for n in ("a", "b")] == [1, 2]


def test_every_step_runs_on_empty_tables(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"pmc_id": "PMC9", "category": "tangential", "confidence": 0.5}\n')
    (tmp_path / "xml").mkdir()
    (tmp_path / "xml" / "PMC9.xml").write_text(PAPER.format(id="PMC9", cites="10.1/1"))
    options = {"triage_log": str(tmp_path / "t.jsonl"), "xml_folder": str(tmp_path / "xml"), "export_folder": str(tmp_path / "out")}
    assert steps.run(spark, str(tmp_path / "tables"), options) == [name for _, name, _ in steps.STEPS]


def test_extraction_limit_and_dry_run(spark, tmp_path):
    from assaymill import schemas
    root = str(tmp_path)
    papers = spark.createDataFrame([(i, f"PMC{i}", f"T{i}", "primary_protocol", "x", "pending") for i in (1, 2, 3)],
                                   "id bigint, pmc_id string, title string, triage_category string, parsed_text_path string, extraction_status string")
    texts = spark.createDataFrame([(i, f"text {i}", "") for i in (1, 2, 3)], "paper_id bigint, text string, abstract string")
    snapshots.commit(spark, root, {"papers": snapshots.align(papers, schemas.TABLES["papers"]), "paper_texts": texts})

    def model(messages):
        arms = '{"protocol_arms": [{"arm_id": "a"}, {"arm_id": "b"}]}' if "arms" in messages[0]["content"] else '{"stages": [], "extraction_confidence": 0.5}'
        return {"choices": [{"message": {"content": arms}}]}
    assert steps.run(spark, root, {"model": model, "dry_run": True}, only=7) and steps.load(spark, root)["protocols"].count() == 0
    assert steps.run(spark, root, {"model": model, "limit": 2}, only=7)
    t = steps.load(spark, root)
    assert {(r["paper_id"], r["protocol_arm"]) for r in t["protocols"].collect()} == {(p, a) for p in (1, 2) for a in "ab"}
    assert t["papers"].where("extraction_status = 'completed'").count() == 2
    assert steps.run(spark, root, {"model": model, "single": "PMC3"}, only=7)
    assert steps.load(spark, root)["protocols"].count() == 6
