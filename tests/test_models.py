import json

from pyspark.sql import functions as F

from assaymill.operators import export, extraction, grounding, manual_fetch


def reply(content, **choice):
    return {"choices": [{"message": {"content": content}, **choice}]}


def test_retries_then_gives_up():
    waits, calls = [], []

    def model(_):
        calls.append(1)
        if len(calls) < 3:
            raise extraction.RetryLater("429", wait=None if len(calls) == 1 else 7.0)
        return reply("ok")

    assert extraction.complete(model, [], waits.append) == ("ok", None) and waits == [1.0, 7.0]

    def busy(_):
        raise extraction.RetryLater("503")

    assert extraction.complete(busy, [], lambda _: None) == (None, "api_error: 503")
    assert extraction.complete(lambda _: reply("", finish_reason="length"), [])[1] == "empty_response: finish_reason=length"
    assert extraction.complete(lambda _: {}, [])[1].startswith("parse_failed")
    assert extraction.complete(lambda _: 1 / 0, [])[1].startswith("api_error")


def test_triage_errors(spark):
    papers = spark.createDataFrame([("a", "t", "good"), ("b", "t", "bogus"), ("c", "t", ""), ("d", "t", "crash")], "pmc_id string, title string, abstract string")
    papers = papers.selectExpr("*", "CAST(NULL AS STRING) AS doi", "CAST(NULL AS STRING) AS pmid", "'kind' AS article_type")

    def model(messages):
        text = messages[-1]["content"]
        assert "Article type: kind" in text
        if "crash" in text:
            raise ValueError("boom")
        category = "review" if "good" in text else "nonsense"
        return {"choices": [{"message": {"content": '{"category": "%s", "confidence": 0.5}' % category}}]}

    got = {r["pmc_id"]: (r["category"], r["error"], r["base_protocols"]) for r in extraction.triage(papers, "s", model).collect()}
    assert got == {"a": ("review", None, []), "b": ("nonsense", "invalid_category: nonsense", []), "c": (None, "no_abstract", []), "d": (None, "api_error: boom", [])}
    again = extraction.retry_errors(extraction.triage(papers, "s", model))
    assert sorted(r["pmc_id"] for r in again.collect()) == ["b", "d"]


def test_arms_default_and_protocols(spark):
    s = spark.createDataFrame([(1, '{"protocol_arms": [{"arm_id": "x", "arm_description": "d", "is_optimized": false}]}'), (2, "{}"), (3, "no")],
                              "paper_id long, reply string")
    got = {r["paper_id"]: (r["arm_id"], r["is_optimized"]) for r in extraction.arms(s).collect()}
    assert got == {1: ("x", False), 2: ("arm_1", True)}
    body = json.dumps({"stages": [{"stage_name": "S", "duration_days": 3, "growth_factors": [{"name": "HGF"}]}], "extraction_confidence": 0.8})
    p = extraction.protocols_from_replies(spark.createDataFrame([(1, f"```json\n{body}\n```")], "paper_id long, reply string"), ["paper_id"]).first()
    assert p["stages"][0]["duration_days"] == "3" and p["stages"][0]["growth_factors"][0]["name"] == "HGF" and p["pass_number"] == 2
    r = extraction.review_rows(spark.createDataFrame([(1, '{"protocol_references": [{"doi": "x"}], "extraction_confidence": 0.4}')], "paper_id long, reply string")).first()
    notes = json.loads(r["extraction_notes"])
    assert notes["protocol_references"] == [{"doi": "x"}] and notes["methodological_insights"] == [] and r["extraction_confidence"] == 0.4


def test_flags(spark):
    calls = spark.createDataFrame([("f", "not_reported", "why"), ("", "not_reported", None), ("f", "bad", None)], "field string, reason string, details string")
    got = [(r["status"], r["message"], r["error"]) for r in extraction.flags_of_calls(calls).collect()]
    assert got == [("flagged", "Recorded: 'f' is incomplete (not_reported). Details: why", None), ("rejected", None, "Missing 'field' parameter"),
                   ("rejected", None, "Invalid reason 'bad'")]


def test_rnaseq_prompt(spark, one):
    df = spark.createDataFrame([("text", ["GSE1", "GSE2"], "supp"), ("text", [], None)], "t string, a array<string>, s string")
    got = [r[0] for r in df.select(extraction.rnaseq_prompt(F.col("t"), F.col("a"), F.col("s"))).collect()]
    assert got == ["Paper text:\ntext\n\nKnown GEO accessions for this paper: GSE1, GSE2\n\nSupplementary text:\nsupp", "Paper text:\ntext"]


def test_grounding(spark):
    df = spark.createDataFrame([("ra", None, "the ratio"), ("ra", None, "RA and"), ("HGF", ["scatter factor"], "a scatter factor x"), ("HGF", ["zz"], "hgf"),
                                ("", None, "x"), (None, None, "x"), ("TGFα", ["tgf"], "tgfα here"), ("long", None, "belonging")],
                               "term string, aliases array<string>, text string")
    got = [r[0] for r in df.select(grounding.is_grounded(F.col("term"), F.col("aliases"), F.lower("text"))).collect()]
    assert got == [False, True, True, False, True, True, False, True]


def test_ground_protocol_report(spark):
    reagent, marker = "array<struct<name:string>>", "array<struct<marker_name:string>>"
    pr = spark.createDataFrame(
        [(1, 9, "old", [("S", [("HGF",), ("Ghost",), (None,)], None, [("ALB",)])], ([("AFP",)],))],
        f"id long, paper_id long, extraction_notes string, stages array<struct<stage_name:string,growth_factors:{reagent},small_molecules:{reagent},stage_markers:{marker}>>, "
        f"endpoint_assessment struct<markers:{marker}>")
    texts = spark.createDataFrame([(9, "Used hepatocyte growth factor.", "albumin seen")], "paper_id long, text string, supplement_text string")
    tables = {"growth_factor": {"HGF": ["hgf", "hepatocyte growth factor"]}, "small_molecule": {}, "marker": {"ALB": ["alb", "albumin"]}}
    g = grounding.note_removals(grounding.ground_protocols(pr, texts, tables))
    r = g.first()
    assert [x["name"] for x in r["stages"][0]["growth_factors"]] == ["HGF", None] and r["stages"][0]["small_molecules"] == []
    assert r["endpoint_assessment"]["markers"] == [] and r["extraction_notes"] == "old | Grounding removed: Ghost, AFP"
    assert {(x["category"], x["term"], x["stage"]) for x in grounding.removal_report(g).collect()} == {("growth_factor", "Ghost", "S"), ("marker", "AFP", "endpoint")}
    assert grounding.top_removed(grounding.removal_counts(g)).count() == 2


def test_flag_resolution_needs_one_match(spark):
    refs = spark.createDataFrame([("p", 0, "10.1/a", "2010", "1", "Si-Tayeb"), ("p", 1, "10.1/b", "2013", "2", "Hannan"), ("p", 2, "10.1/c", "2013", "3", "Hannan")],
                                 "path string, ref_no int, doi string, year string, label string, first_author_surname string")
    flags = spark.createDataFrame([(1, "p", "as in Si-Tayeb et al. 2010"), (2, "p", "Hannan 2013"), (3, "p", "Hannan 2013 [3]"), (4, "p", "ref. 2"), (5, "p", "nothing")],
                                  "flag_id int, path string, details string")
    got = {r["flag_id"]: r["doi"] for r in manual_fetch.resolve_details(flags, refs).collect()}
    # The first author pattern starts at a capital followed by a small letter, so `Si-Tayeb` matches as a whole.
    assert got == {1: "10.1/a", 2: None, 3: "10.1/c", 4: "10.1/b", 5: None}


def test_manual_fetch_round(spark):
    wanted = spark.createDataFrame([("10.1/x.1", "10.1/x.1", "d", 1, "P1"), ("no_doi__smith_2001", None, "Smith 2001", 2, "P2")],
                                   "key string, doi string, description string, protocol_id long, pmc_id string")
    m = manual_fetch.manifest(wanted)
    assert [(r["id"], r["suggested_filename"], r["status"]) for r in m.orderBy("id").collect()] == [
        ("ref_001", "10.1__x.1.pdf", "pending"), ("ref_002", "smith_2001.pdf", "pending")]
    files = spark.createDataFrame([("10.1__X.1.PDF",), ("my smith_2001 copy.pdf",), ("other.pdf",)], "filename string")
    hit = manual_fetch.match_files(files, m)
    assert {(r["filename"], r["id"]) for r in hit.collect()} == {("10.1__X.1.PDF", "ref_001"), ("my smith_2001 copy.pdf", "ref_002")}
    texts = spark.createDataFrame([("10.1__X.1.PDF", "t" * 100), ("my smith_2001 copy.pdf", "short")], "filename string, text string")
    cache, updated = manual_fetch.ingest(hit, texts, m)
    assert [r["doi"] for r in cache.collect()] == ["10.1/x.1"]
    assert {r["id"]: r["status"] for r in updated.collect()} == {"ref_001": "ingested", "ref_002": "pending"}
    protocols = spark.createDataFrame([(1, 70), (2, 71)], "id long, paper_id long")
    assert [r["paper_id"] for r in manual_fetch.papers_to_extract(wanted, updated, protocols).collect()] == [70]
    again = manual_fetch.manifest(wanted, updated)
    assert {r["id"]: r["status"] for r in again.collect()} == {"ref_001": "ingested", "ref_002": "pending"}


def test_sheets_written_if_filled(spark, tmp_path):
    full, empty = spark.range(2), spark.range(0)
    out = export.write_sheets({"protocols": empty, "trajectories": empty, "repository": full}, str(tmp_path))
    assert out == ["protocols", "repository"] and spark.read.parquet(str(tmp_path / "repository")).count() == 2
    export.write_tsv(full, str(tmp_path / "m"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "m")).count() == 2
    export.append_jsonl(full, str(tmp_path / "log"))
    export.append_jsonl(full, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
