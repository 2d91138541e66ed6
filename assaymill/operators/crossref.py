"""Repository cross-referencing: which accessions a paper has and how its data can be had."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import accessions as A


def collect_accessions(extracted: DataFrame, discovered: DataFrame) -> DataFrame:
    """Accessions per paper: those a model extracted `(paper_id, accession, repository, context)` come first,
    mined series `(paper_id, gse_id, context)` fill in. One aggregate instead of a full outer join."""
    one = extracted.where(F.coalesce("accession", F.lit("")) != "").select(
        "paper_id", "accession", F.lit(0).alias("_prio"),
        F.coalesce("repository", A.guess_repository(F.col("accession"))).alias("repository"),
        F.coalesce("context", F.lit("ambiguous")).alias("context"), F.lit("llm_extraction").alias("source"))
    two = discovered.select(
        "paper_id", F.col("gse_id").alias("accession"), F.lit(1).alias("_prio"), F.lit("GEO").alias("repository"),
        F.coalesce("context", F.lit("ambiguous")).alias("context"), F.lit("geo_discovery").alias("source"))
    both = one.unionByName(two)
    return (both.groupBy("paper_id", "accession")
            .agg(F.min(F.struct("_prio", "repository", "context", "source")).alias("x"))
            .select("paper_id", "accession", "x.repository", "x.context", "x.source"))


def classify_availability(accessions: DataFrame, files: DataFrame) -> DataFrame:
    """Availability of a paper's data from its accessions and their files `(accession, has_count_matrix)`."""
    m = files.groupBy("accession").agg(F.bool_or("has_count_matrix").alias("_m"))
    j = accessions.join(m, "accession", "left")
    repo = F.col("repository")
    g = j.groupBy("paper_id").agg(
        F.count(F.lit(1)).alias("n_accessions"), F.bool_or(repo == "GEO").alias("geo"),
        F.bool_or(F.coalesce("_m", F.lit(False))).alias("matrix"), F.bool_or(repo.isin("ENA", "SRA")).alias("ena"),
        F.bool_or(repo == "ArrayExpress").alias("ae"))
    cls = (F.when(F.col("geo") & F.col("matrix"), "geo_with_matrix").when(F.col("geo"), "geo_raw_only")
           .when(F.col("ena"), "ena_only").when(F.col("ae"), "arrayexpress_only").otherwise("no_deposit"))
    return g.select("paper_id", "n_accessions", cls.alias("classification"))


def series_files(soft: DataFrame) -> DataFrame:
    """Supplementary files named in series records `(accession, soft)`, typed and tested for count matrices."""
    lines = soft.select("accession", F.explode(F.split("soft", r"\r?\n")).alias("line"))
    url = F.trim(F.regexp_extract("line", r"^[^=]*=(.*)$", 1))
    f = lines.where(F.col("line").startswith("!Series_supplementary_file")).select("accession", url.alias("url"))
    name = A.file_name(F.col("url"))
    return f.where("url <> ''").select(
        "accession", name.alias("filename"), "url", A.file_type(name).alias("file_type"),
        A.has_count_matrix(name).alias("has_count_matrix"))


def repository_records(accessions: DataFrame, series: DataFrame, runs: DataFrame, files: DataFrame) -> DataFrame:
    """One repository record per (paper, accession): GEO from series records, ENA and SRA from run tables."""
    geo = series.select("accession", F.col("title").alias("project_title"), "organism", "data_type", "platform",
                        F.col("sample_count").cast("int").alias("sample_count"))
    ena = runs.select("accession", F.lit(None).cast("string").alias("project_title"), "organism", "data_type",
                      "platform", F.col("sample_count").cast("int").alias("sample_count"))
    known = geo.unionByName(ena).withColumn("_found", F.lit(True))
    m = files.groupBy("accession").agg(F.bool_or("has_count_matrix").alias("has_processed_matrix"))
    j = accessions.join(known, "accession", "left").join(m, "accession", "left")
    status = (F.when(F.col("_found"), "fetched")
              .when(F.col("repository").isin("GEO", "ENA", "SRA", "ArrayExpress"), "not_found")
              .otherwise("unsupported_repository"))
    return (j.withColumn("fetch_status", status)
            .withColumn("has_processed_matrix", F.coalesce("has_processed_matrix", F.lit(False))).drop("_found"))


def store_availability(rnaseq: DataFrame, availability: DataFrame) -> DataFrame:
    """Classification and accession count written into the paper's data availability."""
    j = rnaseq.join(availability, "paper_id", "left")
    return j.withColumn("data_availability", F.when(F.col("classification").isNotNull(), F.struct(
        F.col("classification"), F.col("n_accessions"))).otherwise(F.lit(None))).drop("classification", "n_accessions")
