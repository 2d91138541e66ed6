"""Dashboard counters and histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill import dims


def _long(row: DataFrame) -> DataFrame:
    """One row of counters as (metric, value) rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in row.columns])
    return row.select(F.inline(cells))


def counters(papers: DataFrame, protocols: DataFrame, values: DataFrame, accessions: DataFrame | None = None,
             samples: DataFrame | None = None, mappings: DataFrame | None = None,
             cache: DataFrame | None = None) -> DataFrame:
    """All single-number counters, one pass over each table."""
    rows = [
        papers.agg(
            F.count(F.lit(1)).alias("total_papers"), F.count("parsed_text_path").alias("papers_with_text"),
            F.count_if(F.col("geo_status") == "linked").alias("geo_papers_linked"),
            F.count("rnaseq_status").alias("rnaseq_checked"),
            F.count_if(F.col("rnaseq_status") == "has_rnaseq").alias("rnaseq_papers")),
        protocols.agg(F.count(F.lit(1)).alias("protocols_extracted")),
        values.agg(
            F.count(F.lit(1)).alias("expression_values_count"),
            F.countDistinct("gene_symbol").alias("expression_genes"),
            F.countDistinct("paper_id").alias("expression_papers")),
    ]
    if accessions is not None:
        rows.append(accessions.agg(F.count_if(F.col("context") == "own_data").alias("geo_series_own_data")))
    if samples is not None:
        rows.append(samples.agg(F.count(F.lit(1)).alias("geo_samples_total")))
    if mappings is not None:
        rows.append(mappings.agg(F.countDistinct("geo_sample_id").alias("geo_mapped_samples")))
    if cache is not None:
        rows.append(cache.agg(F.count(F.lit(1)).alias("corpus_cache_entries")))
    return reduce(DataFrame.unionByName, map(_long, rows))


def by_category(papers: DataFrame) -> DataFrame:
    return papers.groupBy("triage_category").agg(F.count(F.lit(1)).alias("n"))


def by_status(papers: DataFrame) -> DataFrame:
    """Extraction status of the papers that passed triage."""
    return (papers.where(F.col("triage_category").isin(dims.EXTRACTABLE + [dims.REVIEW]))
            .groupBy("extraction_status").agg(F.count(F.lit(1)).alias("n")))


def triage_histogram(log: DataFrame) -> DataFrame:
    """Records per category and with errors, as counts and shares of all records.

    Collapsed to one row per category first; the shares come from those few rows.
    """
    g = log.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("error", F.lit("")) != "").alias("e"))
    over_all = Window.partitionBy(F.lit(0))
    g = g.withColumn("t", F.sum("n").over(over_all))
    cats = g.where(F.coalesce("category", F.lit("")) != "").select("category", "n", "t")
    errors = g.agg(F.sum("e").alias("n"), F.max("t").alias("t")).where("n > 0").select(
        F.lit("errors").alias("category"), "n", "t")
    return cats.unionByName(errors).select(
        "category", "n", (F.col("n") * F.lit(100.0) / F.col("t")).alias("percent"))


def classification_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("classification").agg(F.count(F.lit(1)).alias("n"))
