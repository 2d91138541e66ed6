"""What is left to do: worklists by status, and the anti and semi joins around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill import dims

EVERY = dims.EXTRACTABLE + [dims.REVIEW]


def needing_text(papers: DataFrame) -> DataFrame:
    return papers.where(F.col("triage_category").isin(EVERY) & F.col("parsed_text_path").isNull()
                        & F.col("xml_path").isNotNull()).orderBy("id")


def for_extraction(papers: DataFrame, category: str | None = None) -> DataFrame:
    kinds = [category] if category else dims.EXTRACTABLE
    return papers.where(F.col("triage_category").isin(kinds) & (F.col("extraction_status") == "pending")
                        & F.col("parsed_text_path").isNotNull()).orderBy("processing_priority", "id")


def needing_geo(papers: DataFrame) -> DataFrame:
    return papers.where(F.col("triage_category").isin(EVERY) & (F.col("extraction_status") == "completed")
                        & F.col("geo_status").isNull()).orderBy("id")


def needing_rnaseq(papers: DataFrame) -> DataFrame:
    return papers.where((F.col("extraction_status") == "completed") & F.col("rnaseq_status").isNull()).orderBy("id")


def supplements_to_fetch(papers: DataFrame) -> DataFrame:
    return papers.where(F.col("triage_category").isin(EVERY) & F.col("xml_path").isNotNull()
                        & F.col("supplement_dir").isNull())


def supplements_to_process(papers: DataFrame) -> DataFrame:
    return papers.where((F.col("supplement_dir") != "none") & F.col("supplement_text_path").isNull())


def needing_mapping(papers: DataFrame, accessions: DataFrame, samples: DataFrame, mappings: DataFrame) -> DataFrame:
    """Papers with a sample of their own fetched series that has no stage yet.

    Reduced to distinct paper ids before papers are read, so no wide row is ever de-duplicated.
    """
    own = accessions.where((F.col("context") == "own_data") & F.col("soft_fetched")).select(
        F.col("id").alias("geo_accession_id"), "paper_id")
    open_samples = samples.join(mappings, samples["id"] == mappings["geo_sample_id"], "left_anti")
    ids = open_samples.join(own, "geo_accession_id").select("paper_id").distinct()
    return papers.join(ids, papers["id"] == ids["paper_id"], "left_semi").orderBy("id")


def needing_crossref(papers: DataFrame, rnaseq: DataFrame, repository: DataFrame) -> DataFrame:
    wanted = rnaseq.where(F.col("has_rnaseq") & F.col("accessions").isNotNull()).join(
        repository, "paper_id", "left_anti").select("paper_id")
    return papers.join(wanted, papers["id"] == wanted["paper_id"], "left_semi").orderBy("id")


def needing_enrichment(papers: DataFrame, protocols: DataFrame) -> DataFrame:
    """Completed papers with supplement text and no protocol past pass 2."""
    done = protocols.where(F.col("pass_number") >= 3).select("paper_id")
    return papers.where(
        F.col("supplement_text_path").isNotNull() & (F.col("extraction_status") == "completed")
        & F.col("triage_category").isin(dims.EXTRACTABLE)
    ).join(done, papers["id"] == done["paper_id"], "left_anti").orderBy("id")


def manual_fetch(papers: DataFrame, protocols: DataFrame) -> DataFrame:
    """Protocols waiting for a reference a person must fetch, with their paper."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", F.col("title").alias("paper_title"), "xml_path")
    return protocols.where(F.coalesce("needs_manual_fetch", F.lit(False))).select(
        F.col("id").alias("protocol_id"), "paper_id", "base_protocol_doi", "incomplete_flags").join(p, "paper_id")


def find_paper(papers: DataFrame, paper_id=None, pmc_id=None, doi=None) -> DataFrame:
    """Point lookup; the first identifier given decides."""
    for column, value in (("id", paper_id), ("pmc_id", pmc_id), ("doi", doi)):
        if value is not None:
            return papers.where(F.col(column) == value).limit(1)
    return papers.limit(0)


def by_key(table: DataFrame, column: str, value) -> DataFrame:
    """Rows of a table for one foreign key or gene."""
    return table.where(F.col(column) == value)


def completed_ids(log: DataFrame) -> DataFrame:
    """Ids done in an output log: no error, or only a missing abstract; other errors are tried again."""
    error = F.coalesce("error", F.lit(""))
    return log.where(F.col("pmc_id").isNotNull() & ((error == "") | (error == "no_abstract"))).select(
        "pmc_id").distinct()


def not_done(items: DataFrame, log: DataFrame) -> DataFrame:
    return items.join(completed_ids(log), "pmc_id", "left_anti")


def last_per_key(log: DataFrame, key: list[str], order: str) -> DataFrame:
    """Last record per key of an append log, as an aggregate."""
    rest = [c for c in log.columns if c not in key]
    return (log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("x"))
            .select(*key, *[F.col(f"x.{c}").alias(c) for c in rest]))


def union_dedup(queries: list[DataFrame], key: str = "pmc_id") -> DataFrame:
    """Ids found by several searches, each credited to the first search that found it."""
    every = None
    for i, q in enumerate(queries):
        one = q.select(key).withColumn("query_no", F.lit(i))
        every = one if every is None else every.unionByName(one)
    return every.groupBy(key).agg(F.min("query_no").alias("query_no"))


def net_new(deduped: DataFrame) -> DataFrame:
    """How many ids each search added."""
    return deduped.groupBy("query_no").agg(F.count(F.lit(1)).alias("net_new"))


def protocols_with_expression(protocols: DataFrame, values: DataFrame) -> DataFrame:
    return protocols.join(values, protocols["id"] == values["protocol_id"], "left_semi")


def route_sources(papers: DataFrame, rnaseq: DataFrame, values: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """Where to look for a paper's expression data: deposited matrix, deposited raw, supplement, or text only.

    `listing` (`supplement_dir` rows that exist) stands for the check on disk; without it a set folder counts.
    """
    wanted = rnaseq.where("has_rnaseq").join(values, "paper_id", "left_anti").select(
        "paper_id", F.col("data_availability.classification").alias("_cls"))
    j = papers.join(wanted, papers["id"] == wanted["paper_id"])
    there = F.coalesce(F.col("supplement_dir") != "none", F.lit(False))
    if listing is not None:
        j = j.join(listing.select("supplement_dir", F.lit(True).alias("_there")).distinct(), "supplement_dir", "left")
        there = there & F.coalesce("_there", F.lit(False))
    source = (F.when(F.col("_cls").isin("geo_with_matrix", "geo_raw_only"), F.col("_cls"))
              .when(there, "supplement").otherwise("text_only"))
    return j.select("id", "pmc_id", source.alias("source"))
