"""JSON lines: triage logs into papers and triage results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIAGE_LINE = (
    "pmc_id string, doi string, pmid string, title string, category string, confidence double, reasoning string, "
    "base_protocols array<string>, key_cell_types array<string>, disease_context string, supplement_signal boolean, "
    "error string, _corrupt_record string")


def read_triage(spark: SparkSession, path: str) -> DataFrame:
    """Triage records of a log; blank and malformed lines and records without an id are skipped."""
    # The parse result must be settled before its corrupt column is filtered on.
    lines = spark.read.text(path).select(
        F.from_json("value", TRIAGE_LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        .alias("r"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))
    return (lines.select("r.*", "file", "pos").where(F.col("_corrupt_record").isNull())
            .where(F.coalesce("pmc_id", F.lit("")) != "").drop("_corrupt_record"))


def import_triage(records: DataFrame, papers: DataFrame | None = None,
                  listing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new papers, new triage results): first record per id, papers already there left out.

    `listing` `(pmc_id, xml_path)` supplies the article paths that exist.
    """
    columns = ["doi", "pmid", "title", "category", "confidence", "reasoning", "base_protocols", "key_cell_types",
               "disease_context", "supplement_signal"]
    first = (records.groupBy("pmc_id").agg(F.min_by(F.struct(*columns), F.struct("file", "pos")).alias("x"))
             .select("pmc_id", "x.*"))
    if papers is not None:
        first = first.join(papers, "pmc_id", "left_anti")
    new = first.select("pmc_id", "doi", "pmid", "title", F.col("category").alias("triage_category"))
    if listing is not None:
        new = new.join(listing, "pmc_id", "left")
    else:
        new = new.withColumn("xml_path", F.lit(None).cast("string"))
    new = new.withColumn("extraction_status", F.lit("pending")).withColumn("processing_priority", F.lit(0))
    none = F.array().cast("array<string>")
    results = first.where(F.coalesce("category", F.lit("")) != "").select(
        "pmc_id", "category", "confidence", "reasoning", F.coalesce("base_protocols", none).alias("base_protocols"),
        F.coalesce("key_cell_types", none).alias("key_cell_types"), "disease_context",
        F.coalesce("supplement_signal", F.lit(False)).alias("supplement_signal"))
    return new, results
