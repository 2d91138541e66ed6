import pytest
from pyspark.sql import functions as F

from assaymill.functions import accessions as A
from assaymill.functions import genes, numbers, reagents
from assaymill.functions import stages as S
from assaymill.functions import text as T
from assaymill.operators import audit, manual_fetch

c = F.col


def many(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", fn(c("v")).alias("x")).orderBy("i").collect()]


def test_resolve_alias(spark):
    got = many(spark, genes.resolve_alias, [
        "oct4 ", "ENSG00000163898.14", "213", "ALB_chr4", "NTCP", "GAPDH", "ck19_chr1", "99999", None, "213_chr1"])
    assert got == ["POU5F1", "ALB", "ALB", "ALB", "SLC10A1", "GAPDH", "KRT19", "99999", None, "213"]


def test_is_target_gene_agrees_with_resolution(spark):
    names = ["oct4 ", "ENSG00000163898.14", "213", "ALB_chr4", "GAPDH", "213_chr1", "epcam", "ENSG1", "", "12"]
    slow = many(spark, lambda v: genes.in_panel(genes.resolve_alias(v)), names)
    assert many(spark, genes.is_target_gene, names) == slow


def test_extract_day(spark):
    got = many(spark, S.extract_day, ["WT D6 1", "Day0_Rep1", "5d", "10 days", "x-D14", "none", "CD34 cells"])
    assert got == [6, 0, 5, 10, 14, None, None]


def test_stage_alias_longest_first(spark):
    got = many(spark, S.extract_stage_alias, ["Definitive Endoderm r1", "mature hepatocyte", "hesc", "xyz", "hp1"])
    assert got == ["definitive_endoderm", "mature_hepatocyte", "pre_treatment", None, "hepatoblast"]


def test_stage_ranges_and_days(spark):
    df = spark.createDataFrame([([("A", "3-5 days"), (None, None), ("C", "2")],)],
                               "stages array<struct<stage_name:string,duration_days:string>>")
    r = df.select(S.stage_ranges(c("stages")).alias("r"))
    rows = [tuple(x) for x in r.first()["r"]]
    assert rows == [(1, "A", 0, 3, 3), (2, "stage_2", 3, 3, 0), (3, "C", 3, 5, 2)]
    days = r.select(F.explode(F.array(*map(F.lit, [0, 3, 4, 9]))).alias("d"), "r")
    hit = {x["d"]: (x["a"], x["b"]) for x in days.select(
        "d", S.day_to_stage(c("d"), c("r"))["stage_number"].alias("a"),
        S.day_to_stage(c("d"), c("r"), overflow=False)["stage_number"].alias("b")).collect()}
    assert hit == {0: (1, 1), 3: (1, 1), 4: (3, 3), 9: (3, None)}


def test_numbers(spark):
    assert many(spark, numbers.to_double, [" 3.5 ", "3d", "nan", "inf", "1e-5", "", ".5", None]) == [
        3.5, None, None, None, 1e-5, None, 0.5, None]


def test_comparison_and_files(spark):
    assert many(spark, T.comparison_label, ["DEG_HLC_vs_HEP.xlsx", "d20-VS-d0.csv", "plain.csv"]) == [
        "DEG_HLC vs HEP", "d20 vs d0", None]
    assert many(spark, T.detail_file, ["Supplement DEG: a: b.csv", "none"]) == ["b.csv", None]
    assert many(spark, T.doi_filename, ["10.1002/hep.23354"]) == ["10.1002__hep.23354.pdf"]
    assert many(spark, T.find_doi, ["see (10.1002/hep.1). x", "no"]) == ["10.1002/hep.1", None]


def test_slug(spark):
    got = many(spark, T.slug, ["after Hannan et al. 2013", "Some long description, without a year at all ok", "!!"])
    assert got == ["hannan_et_al_2013", "some_long_description_without_a_year_at", "unknown_ref"]


def test_salvage_json(spark):
    got = many(spark, T.salvage_json, ['{"a": 1}', 'x\n```json\n{"b": 2}\n```', 'pre {"c": {"d": 3}} post', "none", "{open"])
    assert got == ['{"a": 1}', '{"b": 2}', '{"c": {"d": 3}}', None, None]


def test_notes_and_sections(spark, one):
    assert one(T.append_note(c("a"), c("b")), a="old", b="new") == "old | new"
    assert one(T.append_note(c("a"), c("b")), a="", b="new") == "new"
    titles = ["Materials and Methods", "RESULTS", "Discussion", "Background", "Supporting Information", "Abstract", "Funding"]
    assert many(spark, T.section_class, titles) == [
        "methods", "results", "discussion", "introduction", "supplementary", "abstract", "results"]


def test_methods_snippet(spark):
    assert many(spark, lambda v: T.methods_snippet(v, 12), ["abc ## METHODS here", "plain text of it"]) == [
        "## METHODS h", "plain text o"]


def test_accession_helpers(spark):
    assert many(spark, A.find_all, ["GSE12345 then E-MTAB-9 and GSE12345, GSE12"]) == [["GSE12345", "E-MTAB-9"]]
    assert many(spark, A.guess_repository, ["gse1", "SRP2", "ERP3", "E-GEOD-1", "DRA1", "x"]) == [
        "GEO", "SRA", "ENA", "ArrayExpress", "DDBJ", "unknown"]
    assert many(spark, A.context_from_words, ["data were deposited in GEO", "downloaded from GEO", "GSE1"]) == [
        "own_data", "referenced", "ambiguous"]
    assert many(spark, lambda v: v.rlike(A.SKIP_FILE), ["GSE1_RAW.tar", "a.bam", "counts.txt"]) == [True, True, False]


def test_library_type(spark):
    assert many(spark, A.library_data_type, [["RNA-Seq"], ["10x v3"], ["OTHER"], ["ATAC-seq"], ["WGS"], []], "array<string>") == [
        "bulk_rnaseq", "scrna_seq", "microarray", "atac_seq", "unknown", "unknown"]


def test_reagent_formats(spark):
    df = spark.createDataFrame([([("HGF", "10", "ng/ml"), ("OSM", None, None), (None, None, None), ("X", "5", None)],)],
                               "r array<struct<name:string,concentration:string,unit:string>>")
    assert df.select(reagents.reagents(c("r"))).first()[0] == "HGF (10 ng/ml); OSM; X (5 )"


@pytest.mark.parametrize("conf,bucket", [(1.0, "high"), (0.85, "high"), (0.84, "good"), (0.5, "fair"), (0.49, "low"), (None, "low")])
def test_confidence_bucket(spark, conf, bucket):
    df = spark.createDataFrame([(conf,)], "c double")
    assert df.select(audit.confidence_bucket(c("c"))).first()[0] == bucket


def test_reference_id(spark):
    assert many(spark, manual_fetch.reference_id, [7, 1234], "int") == ["ref_007", "ref_1234"]
