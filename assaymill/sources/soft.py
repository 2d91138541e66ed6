"""Series and sample records in line-oriented `key = value` texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, r"\r?\n"), lambda l: F.trim(l))


def _values(lines: Column, prefix: str) -> Column:
    hits = F.filter(lines, lambda l: l.startswith(prefix))
    return F.transform(hits, lambda l: F.trim(F.regexp_replace(l, r"^[^=]*=", "")))


def _last(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(""))


def series(texts: DataFrame) -> DataFrame:
    """Series fields of `(accession, soft)`: last title and platform, summaries joined, first organism, PubMed ids.

    Texts without a series accession, or that say it could not be found, give no row.
    """
    t = texts.where(~F.lower("soft").contains("could not be found")).withColumn("_l", _lines(F.col("soft")))
    v = {k: _values(F.col("_l"), f"!Series_{k}") for k in (
        "geo_accession", "title", "summary", "type", "platform_id", "sample_id", "pubmed_id", "submission_date",
        "organism")}
    return t.where(_last(v["geo_accession"]) != "").select(
        "accession", _last(v["geo_accession"]).alias("gse_id"), _last(v["title"]).alias("title"),
        F.trim(F.array_join(v["summary"], " ")).alias("summary"), _last(v["type"]).alias("data_type"),
        _last(v["platform_id"]).alias("platform"), F.size(v["sample_id"]).alias("sample_count"),
        F.filter(v["pubmed_id"], lambda x: x != "").alias("linked_pmids"),
        _last(v["submission_date"]).alias("submission_date"),
        F.coalesce(F.get(F.filter(v["organism"], lambda x: x != ""), F.lit(0)), F.lit("")).alias("organism"))


def samples(texts: DataFrame) -> DataFrame:
    """One row per `^SAMPLE` record of `(accession, soft)` with title, source, description and characteristics."""
    records = F.split(F.concat(F.lit("\n"), F.col("soft")), r"\n\s*(?=\^SAMPLE)")
    r = texts.select("accession", F.posexplode(records).alias("pos", "rec")).where("pos > 0")
    r = r.withColumn("_l", _lines(F.col("rec")))
    # Each step is a column of its own: an array expression inside a lambda would run once per element.
    r = r.select(
        "accession", _last(_values(F.col("_l"), "^SAMPLE")).alias("gsm_id"),
        _last(_values(F.col("_l"), "!Sample_title")).alias("sample_title"),
        _last(_values(F.col("_l"), "!Sample_source_name")).alias("source_name"),
        _last(_values(F.col("_l"), "!Sample_description")).alias("description"),
        _values(F.col("_l"), "!Sample_characteristics_ch").alias("_traits"),
        F.array_join(F.filter(_values(F.col("_l"), "!Sample_relation"), lambda x: x.rlike("SRA:|SRX")), "\n")
        .alias("_relations"))
    r = r.withColumn("_keys", F.transform("_traits", lambda t: F.trim(F.substring_index(t, ":", 1))))
    r = r.withColumn("_vals", F.transform("_traits", lambda t: F.when(
        t.contains(":"), F.trim(F.regexp_replace(t, r"^[^:]*:", ""))).otherwise(t)))
    r = r.withColumn("_names", F.array_distinct("_keys"))
    # A repeated key keeps its last value.
    r = r.withColumn("_kept", F.transform("_names", lambda k: F.get(F.filter(
        F.reverse(F.arrays_zip("_keys", "_vals")), lambda z: z["_keys"] == k), F.lit(0))["_vals"]))
    runs = F.regexp_extract_all("_relations", F.lit(r"(SRX\d+|SRR\d+)"), F.lit(1))
    return r.select(
        "accession", "gsm_id", "sample_title", "source_name", "description",
        F.map_from_arrays("_names", "_kept").alias("characteristics"), _last(runs).alias("sra_accession"),
    ).where("gsm_id <> ''")


def linked_project(texts: DataFrame) -> DataFrame:
    """(accession, project): the sequencing project a series record points to."""
    hits = F.filter(_lines(F.col("soft")), lambda l: l.rlike("BioProject|PRJNA|PRJEB"))
    found = F.filter(F.transform(hits, lambda l: F.regexp_extract(l, r"(PRJNA\d+|PRJEB\d+)", 1)), lambda x: x != "")
    return texts.select("accession", F.get(found, F.lit(0)).alias("project")).where("project IS NOT NULL")
