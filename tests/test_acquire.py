"""Staged retrieval, and the steps that fetch, extract and retrieve, on filled tables."""

import io
import json
import tarfile

from pyspark.sql import functions as F

from assaymill import schemas, steps
from assaymill.operators import acquire
from assaymill.sources import snapshots


def test_each_tier_runs_for_what_is_left_only(spark):
    calls = []

    def tier(name, rule):
        def run(keys):
            calls.append((name, sorted(r["k"] for r in keys.collect())))
            return keys.where(rule).withColumn("tier", F.lit(name))
        return run

    keys = spark.range(6).withColumnRenamed("id", "k").union(spark.range(3).withColumnRenamed("id", "k"))
    tiers = [tier("a", "k < 2"), tier("b", "k % 2 = 1"), tier("c", "true"), tier("d", "true")]
    got = {(r["k"], r["tier"]) for r in acquire.staged(keys, ["k"], tiers).collect()}
    assert got == {(0, "a"), (1, "a"), (3, "b"), (5, "b"), (2, "c"), (4, "c")}
    assert calls == [("a", [0, 1, 2, 3, 4, 5]), ("b", [2, 3, 4, 5]), ("c", [2, 4])]
    assert acquire.staged(keys.limit(0), ["k"], tiers).count() == 0


def series(platform, rows):
    return "\n".join([f'!Series_platform_id\t"{platform}"', '!Sample_title\t"Day 5"\t"x"', '!Sample_geo_accession\t"GSM1"\t"GSM2"', '"ID_REF"\t"GSM1"\t"GSM2"',
                      *rows, "!series_matrix_table_end"]) + "\n"


def put(spark, root, **tables):
    snapshots.commit(spark, str(root), {n: snapshots.align(df, {**schemas.TABLES, **steps.EXTRA_TABLES}[n]) for n, df in tables.items()})


def test_expression_step(spark, tmp_path):
    folder, supp = tmp_path / "m", tmp_path / "s" / "PMC6_supp"
    folder.mkdir(), supp.mkdir(parents=True)
    (folder / "GSE1_series_matrix.txt").write_text(series("GPL570", ['"albumin"\t1\t2', '"p1"\t3\t4']))
    (folder / "GSE2_series_matrix.txt").write_text(series("GPL16791", ['"p1"\t3\t4']))
    (folder / "GSE2_counts.txt").write_text("gene\tGSM1\tother\nOCT4\t7\tx\n")
    (folder / "GSE3_more.csv").write_text("gene,s\nAFP,8\n")
    (folder / "GSE4_tpm.csv").write_text("gene,s\nAFP,9\n")
    (folder / "GSE5_norm.csv").write_text("gene,s\nAFP,10\n")
    (supp / "DEG_HLC_vs_HEP.csv").write_text("gene,log2FC,padj\nALB,1.5,0.01\nFOO,1,1\n")
    (supp / "tpm.csv").write_text("gene,WT,tpm\nALB,3,4\n")
    papers = spark.createDataFrame([(i, f"PMC{i}", "x") for i in range(1, 9)], "id bigint, pmc_id string, supplement_dir string")
    accessions = spark.createDataFrame([(1, 1, "GSE1", "own_data", None), (2, 2, "GSE2", "own_data", None), (3, 3, "GSE3", "own_data", None), (4, 4, "GSE9", "own_data", None),
                                        (5, 4, "GSE4", "referenced", None), (7, 7, "GSE5", "referenced", None)],
                                       "id bigint, paper_id bigint, gse_id string, context string, platform string")
    kinds = {6: "no_deposit", 8: "no_deposit"}
    rnaseq = spark.createDataFrame([(i, True, "TPM", (None, kinds.get(i, "geo_raw_only"), 1)) for i in range(1, 9)],
                                   "paper_id bigint, has_rnaseq boolean, normalization string, data_availability struct<repository:string,classification:string,n_accessions:bigint>")
    repository = spark.createDataFrame([(7, "GSE5", True, [("GSE5_norm.csv", "u", "text_table", True)])],
                                       "paper_id bigint, accession string, has_processed_matrix boolean, supplementary_files array<struct<filename:string,url:string,file_type:string,has_count_matrix:boolean>>")
    samples = spark.createDataFrame([(1, 1, "GSM1", "t")], "id bigint, geo_accession_id bigint, gsm_id string, sample_title string")
    mappings = spark.createDataFrame([(1, 11, "S", 1, 5, "day five")], "geo_sample_id bigint, protocol_id bigint, stage_name string, stage_number int, time_point_day int, condition_label string")
    protocols = spark.createDataFrame([(11, 1)], "id bigint, paper_id bigint")
    values = spark.createDataFrame([(8, "ALB", 1.0)], "paper_id bigint, gene_symbol string, value double")
    put(spark, tmp_path / "t", papers=papers, geo_accessions=accessions, rnaseq_metadata=rnaseq, repository_metadata=repository, geo_samples=samples,
        geo_sample_stage_mappings=mappings, protocols=protocols, expression_values=values)
    options = {"matrix_folder": str(folder), "supplement_folder": str(tmp_path / "s"), "export_folder": str(tmp_path / "e")}
    assert steps.run(spark, str(tmp_path / "t"), options, only=13) == ["retrieve_expression"]
    rows = steps.load(spark, str(tmp_path / "t"))["expression_values"].collect()
    got = {(r["paper_id"], r["gene_symbol"], r["value"], r["unit"], r["condition_label"], r["source_detail"], r["confidence"]) for r in rows}
    assert got == {
        (1, "ALB", 1.0, "TPM", "day five", "GSE1 series matrix", 0.95), (1, "ALB", 2.0, "TPM", "GSM2", "GSE1 series matrix", 0.95),
        (2, "POU5F1", 7.0, "TPM", "GSM1", "GSE2 supplementary", 0.90), (3, "AFP", 8.0, "unknown", "s", "GSE3 disk fallback: GSE3_more.csv", 0.85),
        (4, "AFP", 9.0, "unknown", "s", "GSE4 disk fallback (all accs): GSE4_tpm.csv", 0.80),
        (6, "ALB", 1.5, "log2FC", None, "Supplement DEG: DEG_HLC_vs_HEP.csv", 0.85), (6, "ALB", 3.0, "unknown", "WT", "Supplement expression: tpm.csv", 0.80),
        (6, "ALB", 4.0, "unknown", "tpm", "Supplement expression: tpm.csv", 0.80),
        (7, "AFP", 10.0, "unknown", "s", "GSE5 supplementary: GSE5_norm.csv", 0.90), (8, "ALB", 1.0, None, None, None, None)}
    by = {(r["paper_id"], r["value"]): r for r in rows}
    assert by[1, 1.0]["time_point_day"] == 5 and by[1, 1.0]["gene_alias"] == "albumin" and by[6, 1.5]["comparison"] == "DEG_HLC vs HEP"
    assert spark.read.json(str(tmp_path / "e" / "markers")).count() == 9
    # All have values now: a second run adds nothing.
    assert steps.run(spark, str(tmp_path / "t"), options, only=13) == ["retrieve_expression"]
    assert steps.load(spark, str(tmp_path / "t"))["expression_values"].count() == 10


def test_packages_become_supplements(spark, tmp_path):
    packages = tmp_path / "p"
    packages.mkdir()
    for pmc, members in (("PMC1", {"PMC1/x_MOESM1.csv": b"gene,a\nALB,1\n", "PMC1/fig.jpg": b"j"}), ("PMC2", {"PMC2/fig.jpg": b"j"})):
        with tarfile.open(packages / f"{pmc}.tar.gz", "w:gz") as t:
            for name, data in members.items():
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    papers = spark.createDataFrame([(i, f"PMC{i}", "review", "x") for i in (1, 2, 3)], "id bigint, pmc_id string, triage_category string, xml_path string")
    put(spark, tmp_path / "t", papers=papers)
    options = {"package_folder": str(packages)}
    assert steps.run(spark, str(tmp_path / "t"), options, only=3) == ["fetch_supplements"]
    assert steps.run(spark, str(tmp_path / "t"), options, only=4) == ["read_supplements"]
    t = steps.load(spark, str(tmp_path / "t"))
    assert {r["id"]: r["supplement_dir"] for r in t["papers"].collect()} == {1: "supplement_files/1", 2: "none", 3: None}
    assert [(r["paper_id"], r["filename"]) for r in t["supplement_files"].collect()] == [(1, "x_MOESM1.csv")]
    assert [(r["paper_id"], "ALB,1" in r["supplement_text"]) for r in t["paper_supplements"].collect()] == [(1, True)]


def test_sequencing_metadata_step(spark, tmp_path):
    def answer(messages):
        text = messages[-1]["content"]
        if "fails" in text:
            raise RuntimeError("down")
        reply = "no json" if "odd" in text else json.dumps({"has_rnaseq": "seq" in text, "rnaseq_type": "bulk", "normalization": "GSE7" if "GSE7" in text else None,
                                                           "accessions": [{"repository": "GEO", "accession": "GSE7"}]})
        return {"choices": [{"message": {"content": reply}}]}

    papers = spark.createDataFrame([(i, f"PMC{i}", "completed") for i in range(1, 6)], "id bigint, pmc_id string, extraction_status string")
    texts = spark.createDataFrame([(1, "seq"), (2, "none"), (3, "odd"), (4, "fails")], "paper_id bigint, text string")
    accessions = spark.createDataFrame([(1, 1, "GSE7")], "id bigint, paper_id bigint, gse_id string")
    put(spark, tmp_path, papers=papers, paper_texts=texts, geo_accessions=accessions)
    assert steps.run(spark, str(tmp_path), {"model": answer}, only=11) == ["extract_rnaseq"]
    t = steps.load(spark, str(tmp_path))
    assert {r["id"]: r["rnaseq_status"] for r in t["papers"].collect()} == {1: "has_rnaseq", 2: "checked_none", 3: "checked_none", 4: None, 5: "checked_none"}
    rows = {r["paper_id"]: (r["has_rnaseq"], r["normalization"], len(r["accessions"])) for r in t["rnaseq_metadata"].collect()}
    assert rows == {1: (True, "GSE7", 1), 2: (False, None, 1)}
