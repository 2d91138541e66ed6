"""Fill missing values of stored measurements and repository records; present values never change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.functions.stages import extract_day
from assaymill.operators.joins import left_lookup


def comparison(values: DataFrame) -> DataFrame:
    """Comparison label from the file named in the source detail.

    A detail qualifies once a supplement-table row with DEG in it lacks the label; then every row with that
    same detail is filled. Which details qualify is a short list of distinct values, not a self-join of rows.
    """
    label = T.comparison_label(T.detail_file(F.col("source_detail")))
    wanted = (values.where(F.col("comparison").isNull() & (F.col("source_type") == "supplement_table")
                           & F.col("source_detail").ilike("%DEG%"))
              .select("source_detail").distinct().withColumn("_hit", F.lit(True)))
    j = left_lookup(values, wanted, ["source_detail"])
    fill = F.when(F.col("_hit"), label)
    return j.withColumn("comparison", F.coalesce("comparison", fill)).select(*values.columns)


def day_from_label(values: DataFrame) -> DataFrame:
    """Day named in the condition label."""
    found = F.when(F.col("condition_label") != "", extract_day(F.col("condition_label")))
    return values.withColumn("time_point_day", F.coalesce("time_point_day", found))


def day_from_mapping(values: DataFrame, mappings: DataFrame) -> DataFrame:
    """Day of a sample mapping with the same protocol and label; of several the earliest."""
    days = (mappings.where(F.col("time_point_day").isNotNull() & (F.col("condition_label") != ""))
            .groupBy("protocol_id", "condition_label").agg(F.min("time_point_day").alias("_day")))
    return (left_lookup(values, days, ["protocol_id", "condition_label"])
            .withColumn("time_point_day", F.coalesce("time_point_day", "_day")).select(*values.columns))


def day_coverage(values: DataFrame) -> DataFrame:
    """How many measurements have a day."""
    return values.agg(F.count(F.lit(1)).alias("total"), F.count("time_point_day").alias("has_day")).withColumn(
        "percent", F.col("has_day") * F.lit(100.0) / F.nullif(F.col("total"), F.lit(0)))


def repository_records(records: DataFrame, accessions: DataFrame) -> DataFrame:
    """Organism of GEO records from the accession table, where empty."""
    acc = accessions.select("paper_id", F.col("gse_id").alias("accession"), F.lit("GEO").alias("repository"),
                            F.col("organism").alias("_organism"))
    j = records.join(acc, ["paper_id", "accession", "repository"], "left")
    return (j.withColumn("organism", F.coalesce(F.nullif(F.col("organism"), F.lit("")), "_organism"))
            .select(*records.columns))


def repository_samples(records: DataFrame, accessions: DataFrame, samples: DataFrame,
                       known: DataFrame | None = None) -> DataFrame:
    """Sample rows `(paper_id, accession, gsm_id, title, source)` of GEO records that have none in `known` yet.

    Rows of their own instead of a list inside the record: one series may have most of all samples.
    """
    todo = records.where(F.col("repository") == "GEO").select("paper_id", F.col("accession").alias("gse_id"))
    if known is not None:
        todo = todo.join(known.select("paper_id", F.col("accession").alias("gse_id")), ["paper_id", "gse_id"], "left_anti")
    acc = accessions.select(F.col("id").alias("geo_accession_id"), "paper_id", "gse_id").join(
        todo, ["paper_id", "gse_id"], "left_semi")
    return samples.join(acc, "geo_accession_id").select(
        "paper_id", F.col("gse_id").alias("accession"), "gsm_id", F.col("sample_title").alias("title"),
        F.col("source_name").alias("source"))


def paths_from_listing(papers: DataFrame, listing: DataFrame) -> DataFrame:
    """Supplement folder and text path of papers from a listing `(pmc_id, supplement_dir, supplement_text_path)`."""
    found = listing.select("pmc_id", F.col("supplement_dir").alias("_dir"), F.col("supplement_text_path").alias("_txt"))
    j = papers.join(found, "pmc_id", "left")
    return (j.withColumn("supplement_dir", F.when(
                F.col("xml_path").isNotNull() & (F.col("supplement_dir").isNull() | (F.col("supplement_dir") == "none")),
                F.coalesce("_dir", "supplement_dir")).otherwise(F.col("supplement_dir")))
            .withColumn("supplement_text_path", F.coalesce(F.nullif(F.col("supplement_text_path"), F.lit("")), "_txt"))
            .select(*papers.columns))
