"""Keyed upserts, appends and cascading deletes as functions from tables to tables.

A batch of upserts is one aggregation over old and new rows by key: each column keeps its own rule over
the write order. It combines map-side, so a key written a billion times costs no single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.operators.ranking import record_breakers


def latest(c: str, seq: Column) -> Column:
    """Value of the last write, missing or not."""
    return F.max_by(F.struct(F.col(c).alias("v")), seq)["v"]


def latest_present(c: str, seq: Column) -> Column:
    """Last value that is not missing."""
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), seq))


def earliest(c: str, seq: Column) -> Column:
    return F.min_by(F.struct(F.col(c).alias("v")), seq)["v"]


def upsert(old: DataFrame, new: DataFrame, key: list[str], rules: dict[str, str], order: str = "seq") -> DataFrame:
    """Merge `new` (several writes per key, in `order`) into `old` (one row per key).

    Rules: `overwrite`, `coalesce` (new unless missing), `max` (missing counts as 0, or false), `keep`.
    """
    columns = [*key, *rules]
    seq = F.col("_seq")
    both = old.select(*columns, F.lit(-1).cast("bigint").alias("_seq")).unionByName(
        new.select(*columns, F.col(order).cast("bigint").alias("_seq")))
    types = dict(both.dtypes)
    aggs = []
    for c, rule in rules.items():
        if rule == "overwrite":
            e = latest(c, seq)
        elif rule == "coalesce":
            e = latest_present(c, seq)
        elif rule == "keep":
            e = earliest(c, seq)
        elif rule == "max":
            zero = F.lit(False) if types[c] == "boolean" else F.lit(0).cast(types[c])
            e = F.max(F.coalesce(F.col(c), zero))
        else:
            raise ValueError(f"unknown rule {rule!r} for {c}")
        aggs.append(e.alias(c))
    return both.groupBy(*key).agg(*aggs)


# Merge rules of the tables.
GEO_ACCESSION = {
    "context": "coalesce", "confidence": "max", "discovery_strategies": "overwrite", "data_type": "coalesce",
    "platform": "coalesce", "sample_count": "coalesce", "series_title": "coalesce", "series_summary": "coalesce",
    "linked_pmids": "coalesce", "submission_date": "coalesce", "soft_fetched": "max", "organism": "coalesce",
}
GEO_SAMPLE = dict.fromkeys(
    ["sample_title", "source_name", "description", "characteristics", "sra_accession"], "coalesce")
SAMPLE_MAPPING = dict.fromkeys(
    ["stage_name", "stage_number", "time_point_day", "condition_label", "mapping_confidence", "mapping_method"],
    "overwrite")
RNASEQ_METADATA = dict.fromkeys(
    ["has_rnaseq", "rnaseq_type", "technology", "library_prep", "read_type", "read_length_bp", "sequencing_depth",
     "genome_build", "annotation", "alignment_tool", "quantification_tool", "normalization", "de_method",
     "accessions", "deg_summary", "pathway_analysis", "data_availability", "extraction_notes"], "overwrite")
REPOSITORY_METADATA = {
    "repository": "overwrite", "project_title": "coalesce", "organism": "coalesce", "data_type": "coalesce",
    "platform": "coalesce", "sample_count": "coalesce", "has_processed_matrix": "max",
    "supplementary_files": "coalesce", "fetch_status": "overwrite", "raw_response": "coalesce",
}


def cache_longest(old: DataFrame, new: DataFrame, order: str = "seq", chunk: int = 100_000) -> DataFrame:
    """Text cache: per DOI only a longer text replaces the cached one, and then also a title or PMC id if given.

    Rows without a DOI are always kept. Replacements are the rows longer than all before them.
    """
    columns = ["doi", "pmc_id", "title", "full_text", "source"]
    both = old.select(*columns, F.lit(-1).cast("bigint").alias("_seq")).unionByName(
        new.select(*columns, F.col(order).cast("bigint").alias("_seq")))
    # Only lengths travel through the windows; the texts of the rows they single out are read after.
    keyed = both.where("doi <> ''")
    sized = keyed.select("doi", "_seq", F.coalesce(F.length("full_text"), F.lit(0)).alias("_len"))
    winners = record_breakers(sized, ["doi"], "_seq", "_len", chunk).select("doi", "_seq")
    kept = keyed.join(winners, ["doi", "_seq"], "left_semi")
    seq = F.col("_seq")
    merged = kept.groupBy("doi").agg(
        latest_present("pmc_id", seq).alias("pmc_id"), latest_present("title", seq).alias("title"),
        latest("full_text", seq).alias("full_text"), latest("source", seq).alias("source"))
    return merged.select(*columns).unionByName(both.where("doi IS NULL OR doi = ''").select(*columns))


def longest_text(cache: DataFrame, key: str = "doi") -> DataFrame:
    """Cached row with the longest text per key; equal lengths resolve by title and text."""
    rest = [c for c in cache.columns if c != key]
    best = cache.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.struct((-F.length("full_text")).alias("_l"), *rest)).alias("x"))
    return best.select(key, *[F.col(f"x.{c}").alias(c) for c in rest])


def append_rows(table: DataFrame, new: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Insert rows, filling absent or missing columns with their defaults."""
    for c, value in (defaults or {}).items():
        given = F.col(c) if c in new.columns else F.lit(None)
        new = new.withColumn(c, F.coalesce(given, F.lit(value)))
    return table.unionByName(new, allowMissingColumns=True)


def append_absent(table: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Insert rows whose key is not there yet."""
    return table.unionByName(new.join(table, key, "left_anti"), allowMissingColumns=True)


def patch(table: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Set the listed columns of the rows named in `updates` (one row per key)."""
    u = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    j = table.join(u, key, "left")
    return j.select(*[
        F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in table.columns])


def delete_accessions(accessions: DataFrame, samples: DataFrame, mappings: DataFrame,
                      doomed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remove accessions (by `id`) with their samples and those samples' mappings."""
    ids = doomed.select(F.col("id").alias("_acc")).distinct()
    dead_samples = samples.join(ids, samples["geo_accession_id"] == F.col("_acc"), "left_semi").select(
        F.col("id").alias("_sample"))
    return (
        accessions.join(ids, accessions["id"] == F.col("_acc"), "left_anti"),
        samples.join(ids, samples["geo_accession_id"] == F.col("_acc"), "left_anti"),
        mappings.join(dead_samples, mappings["geo_sample_id"] == F.col("_sample"), "left_anti"),
    )


def delete_protocols(protocols: DataFrame, paper_ids: DataFrame) -> DataFrame:
    return protocols.join(paper_ids.select("paper_id").distinct(), "paper_id", "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
