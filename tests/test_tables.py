from pyspark.sql import functions as F

from assaymill import schemas
from assaymill.operators import backfill, mapping, retrieval, search, upserts, worklists
from assaymill.sources import snapshots


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_schemas_parse(spark):
    for name, ddl in schemas.TABLES.items():
        assert snapshots.align(spark.createDataFrame([], "id bigint"), ddl).columns[0], name


def test_accession_upsert_rules(spark):
    ddl = ("paper_id long, gse_id string, context string, confidence double, discovery_strategies array<string>, data_type string, "
           "platform string, sample_count int, series_title string, series_summary string, linked_pmids array<string>, "
           "submission_date string, soft_fetched boolean, organism string")
    none = [None] * 6
    old = spark.createDataFrame([(1, "GSE1", "own_data", 0.9, ["a"], "rna", *none, True, "human")], ddl)
    new = spark.createDataFrame([(1, "GSE1", None, 0.5, ["b"], None, *none, False, None, 0), (1, "GSE1", "ambiguous", None, ["c"], None, *none, None, None, 1),
                                 (2, "GSE2", None, None, ["d"], None, *none, None, None, 2)], ddl + ", seq long")
    got = {r["gse_id"]: r for r in upserts.upsert(old, new, ["paper_id", "gse_id"], upserts.GEO_ACCESSION).collect()}
    a = got["GSE1"]
    assert (a["context"], a["confidence"], a["discovery_strategies"], a["data_type"], a["soft_fetched"], a["organism"]) == (
        "ambiguous", 0.9, ["c"], "rna", True, "human")
    assert got["GSE2"]["confidence"] == 0.0 and got["GSE2"]["soft_fetched"] is False


def test_map_columns_survive_upsert(spark):
    ddl = "k int, characteristics map<string,string>"
    out = upserts.upsert(spark.createDataFrame([(1, {"a": "b"})], ddl), spark.createDataFrame([(1, None, 0)], ddl + ", seq long"),
                         ["k"], {"characteristics": "coalesce"})
    assert out.first()["characteristics"] == {"a": "b"}


def test_cache_longest(spark):
    ddl = "doi string, pmc_id string, title string, full_text string, source string"
    old = spark.createDataFrame([("d", "P", "T", "12345", "s0")], ddl)
    new = spark.createDataFrame([("d", None, "short", "123", "s1", 0), ("d", None, None, "1234567", "s2", 1), ("d", "Q", "same", "7654321", "s3", 2),
                                 (None, None, "x", "1", "s4", 3), (None, None, "x", "1", "s4", 4)], ddl + ", seq long")
    got = rows(upserts.cache_longest(old, new), F.col("doi").asc_nulls_last(), "source")
    assert got == [("d", "P", "T", "1234567", "s2"), (None, None, "x", "1", "s4"), (None, None, "x", "1", "s4")]


def test_append_defaults_and_absent(spark):
    t = spark.createDataFrame([(1, 0.5)], "id int, confidence double")
    out = upserts.append_rows(t, spark.createDataFrame([(2,)], "id int"), {"confidence": 0.7})
    assert rows(out, "id") == [(1, 0.5), (2, 0.7)]
    assert rows(upserts.append_absent(t, spark.createDataFrame([(1, 9.0), (3, 1.0)], "id int, confidence double"), ["id"]), "id") == [(1, 0.5), (3, 1.0)]
    assert upserts.delete_protocols(spark.createDataFrame([(1, 5), (2, 6)], "id int, paper_id int"),
                                    spark.createDataFrame([(5,)], "paper_id int")).count() == 1


def test_backfills_touch_only_missing(spark):
    ddl = ("id int, protocol_id long, condition_label string, time_point_day int, comparison string, source_type string, source_detail string")
    v = spark.createDataFrame([
        (1, 7, "D5 x", None, None, "supplement_table", "Supplement DEG: deg_a_vs_b.csv"), (2, 7, "L", None, "kept", "supplement_table", "Supplement DEG: deg_a_vs_b.csv"),
        (3, 7, "L", 3, None, "geo_matrix", "Supplement DEG: deg_a_vs_b.csv"), (4, 7, "", None, None, "geo_matrix", "DEG none"), (5, None, "L", None, None, "x", None)], ddl)
    assert rows(backfill.comparison(v).select("id", "comparison"), "id") == [(1, "deg_a vs b"), (2, "kept"), (3, "deg_a vs b"), (4, None), (5, None)]
    assert rows(backfill.day_from_label(v).select("id", "time_point_day"), "id") == [(1, 5), (2, None), (3, 3), (4, None), (5, None)]
    m = spark.createDataFrame([(7, "L", 9), (7, "L", 8), (7, "L", None)], "protocol_id long, condition_label string, time_point_day int")
    assert rows(backfill.day_from_mapping(v, m).select("id", "time_point_day"), "id") == [(1, None), (2, 8), (3, 3), (4, None), (5, None)]


def test_paths_from_listing(spark):
    p = spark.createDataFrame([("a", "x", "none", None), ("b", None, None, None), ("c", "x", "kept", "t")],
                              "pmc_id string, xml_path string, supplement_dir string, supplement_text_path string")
    listing = spark.createDataFrame([(k, f"{k}_dir", f"{k}_txt") for k in "abc"], "pmc_id string, supplement_dir string, supplement_text_path string")
    assert rows(backfill.paths_from_listing(p, listing), "pmc_id") == [
        ("a", "x", "a_dir", "a_txt"), ("b", None, None, "b_txt"), ("c", "x", "kept", "t")]


def test_tier1_and_tier2(spark):
    stages = [("Definitive endoderm", "3"), ("Maturation", "4")]
    pr = spark.createDataFrame([(10, 1, stages), (11, 1, [])], "id long, paper_id long, stages array<struct<stage_name:string,duration_days:string>>")
    acc = spark.createDataFrame([(5, 1, "own_data"), (6, 1, "referenced")], "id long, paper_id long, context string")
    s = spark.createDataFrame([(1, 5, "G1", "Day 2 endoderm", None), (2, 5, "G2", "D9", "x"), (3, 5, "G3", "ipsc", None), (4, 5, "G4", "HLC", ""),
                               (5, 5, "G5", "control", None), (6, 6, "G6", "D1", None)],
                              "id long, geo_accession_id long, gsm_id string, sample_title string, source_name string")
    mapped, rest = mapping.tier1(mapping.sample_pairs(s, acc, pr))
    got = {r["geo_sample_id"]: (r["stage_number"], r["time_point_day"], r["condition_label"], r["mapping_confidence"]) for r in mapped.collect()}
    assert got == {1: (1, 2, "definitive_endoderm", 0.9), 2: (2, 9, "Maturation", 0.7), 3: (0, 0, "pre_treatment", 0.7), 4: (2, 3, "mature_hepatocyte", 0.7)}
    answers = spark.createDataFrame([(10, "G5", 2, 6, None, None)],
                                    "protocol_id long, gsm_id string, stage_number int, time_point_day int, condition_label string, confidence double")
    r = mapping.tier2(rest, answers).first()
    assert (r["geo_sample_id"], r["stage_name"], r["mapping_confidence"], r["mapping_method"]) == (5, "Maturation", 0.6, "tier2_llm")
    assert "Stage 2: Maturation (Day 3-7, 4 days)" in mapping.stage_prompt(pr).where("protocol_id = 10").first()["prompt"]


def test_candidate_files(spark):
    f = spark.createDataFrame([("A", "x_RAW.tar", 1), ("A", "b_counts.txt.gz", 10), ("A", "a_tpm.csv", 200_000_000), ("B", "plain.txt.gz", 5), ("B", "plain.txt", 5)],
                              "gse_id string, filename string, size long")
    every = sorted((r["gse_id"], r["filename"]) for r in retrieval.candidate_files(f).collect())
    assert every == [("A", "a_tpm.csv"), ("A", "b_counts.txt.gz"), ("B", "plain.txt.gz")]
    small = sorted((r["gse_id"], r["filename"]) for r in retrieval.candidate_files(f, max_bytes=100_000_000).collect())
    assert small == [("A", "b_counts.txt.gz"), ("B", "plain.txt.gz")]
    assert [r["filename"] for r in retrieval.candidate_files(f.where("gse_id = 'A'"), max_files=1).collect()] == ["a_tpm.csv"]


def test_deg_measurements(spark):
    d = spark.createDataFrame([(1, 2, "d_x_vs_y.csv", "oct4", 1.5, 0.1), (1, 2, "d.csv", "ALB", None, 0.1)],
                              "paper_id long, protocol_id long, filename string, gene string, log2fc double, padj double")
    r = retrieval.deg_measurements(d).collect()
    assert [(x["gene_symbol"], x["unit"], x["comparison"], x["confidence"], x["source_detail"]) for x in r] == [
        ("POU5F1", "log2FC", "d_x vs y", 0.85, "Supplement DEG: d_x_vs_y.csv")]


def test_search(spark):
    papers = spark.createDataFrame([(1, "P1", "10.1/a", "Liver cells"), (2, "P2", None, "10.1/a in LIVER"), (3, "P3", "10.1/b", "x")],
                                   "id long, pmc_id string, doi string, title string")
    pr = spark.createDataFrame([(5, 1, "a1", 0.5), (6, 1, "a2", 0.5), (7, 2, "b", 0.5)], "id long, paper_id long, protocol_arm string, extraction_confidence double")
    assert [r["protocol_id"] for r in search.search_corpus(papers, pr, "10.1/a").collect()] == [5, 6, 7]
    assert [r["protocol_id"] for r in search.search_corpus(papers, pr, "liver", limit=2).collect()] == [5, 6]
    assert search.search_corpus(papers, pr, "nothing").count() == 0
    cache = spark.createDataFrame([("10.1/z", None, "Zed", "short"), ("10.1/z", None, "Zed", "longer text")], "doi string, pmc_id string, title string, full_text string")
    assert [r["text_preview"] for r in search.search_cache(cache, "10.1/z").collect()] == ["longer text..."]
    assert search.search_cache(cache, "zed").count() == 2


def test_resume(spark):
    log = spark.createDataFrame([("a", None), ("b", "api_error: x"), ("c", "no_abstract"), (None, None)], "pmc_id string, error string")
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "pmc_id string")
    assert rows(worklists.not_done(items, log), "pmc_id") == [("b",), ("d",)]
    assert worklists.find_paper(items, pmc_id="b").count() == 1 and worklists.find_paper(items).count() == 0
