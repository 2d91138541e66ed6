"""Corpus search: DOI first, then titles; the text cache as a fallback; reference texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.functions.reagents import stage_summary
from assaymill.operators.joins import left_lookup

RESULT = ["paper_id", "pmc_id", "doi", "title", "protocol_id", "protocol_arm", "extraction_confidence"]


def _doi(query: str) -> str:
    return query.replace("https://doi.org/", "").replace("http://doi.org/", "")


def _like(query: str) -> str:
    return f"%{query}%"


def search_corpus(papers: DataFrame, protocols: DataFrame, query: str, limit: int = 5,
                  extra: list[str] | None = None) -> DataFrame:
    """Protocols whose paper has the DOI, then those whose title holds the query, papers seen left out.

    The limit is the feature: each branch is a top-k by id before the two are put in order.
    """
    extra = extra or []
    columns = RESULT + extra
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi", "title")
    pr = protocols.withColumnRenamed("id", "protocol_id")
    by_title = p.where(F.col("title").ilike(_like(query))).withColumn("_prio", F.lit(1))
    if T.looks_like_doi(query):
        by_doi = p.where(F.col("doi") == _doi(query)).withColumn("_prio", F.lit(0))
        hits = by_doi.unionByName(by_title.where(~F.coalesce(F.col("doi") == _doi(query), F.lit(False))))
    else:
        hits = by_title
    found = hits.join(pr, "paper_id").select("_prio", *columns)
    return found.orderBy("_prio", "paper_id", "protocol_id").limit(limit).drop("_prio")


def with_stage_summary(found: DataFrame) -> DataFrame:
    return found.withColumn("stages_summary", stage_summary(F.col("stages"))).drop("stages")


def search_cache(cache: DataFrame, query: str, limit: int = 5) -> DataFrame:
    """Cached texts for a query: the longest one with the DOI, else titles."""
    by_title = (cache.where(F.col("title").ilike(_like(query))).orderBy("doi", "title").limit(limit)
                .select("doi", "pmc_id", "title", F.lit(None).cast("string").alias("text_preview")))
    if not T.looks_like_doi(query):
        return by_title
    by_doi = (cache.where(F.col("doi") == _doi(query)).orderBy(F.desc(F.length("full_text"))).limit(1)
              .select("doi", "pmc_id", "title",
                      F.concat(F.left("full_text", F.lit(500)), F.lit("...")).alias("text_preview")))
    both = by_doi.withColumn("_prio", F.lit(0)).unionByName(by_title.withColumn("_prio", F.lit(1)))
    # At most limit + 1 rows are left: the best kind of hit stays.
    first = F.min("_prio").over(Window.partitionBy(F.lit(0)))
    return both.withColumn("_first", first).where("_prio = _first").drop("_prio", "_first")


def reference_texts(requests: DataFrame, cache: DataFrame, papers: DataFrame, budget: int | None = None) -> DataFrame:
    """Text of requested references `(doi, pmid)` from the cache, else the corpus; the rest must be fetched.

    `papers` carries `full_text`. Only references asked for are read; one text per identifier is kept, whole
    unless a budget in characters is given.
    """
    best = (cache.where("full_text <> ''").groupBy("doi").agg(F.max_by(F.struct("title", "full_text"), F.length("full_text")).alias("c")))
    by_doi = papers.where("full_text IS NOT NULL").groupBy("doi").agg(F.max_by(F.struct("title", "full_text"), "id").alias("d"))
    by_pmid = papers.where("full_text IS NOT NULL").groupBy("pmid").agg(F.max_by(F.struct("title", "full_text"), "id").alias("p"))
    j = left_lookup(left_lookup(requests, best, ["doi"]), by_doi, ["doi"])
    j = left_lookup(j, by_pmid, ["pmid"])
    hit = F.coalesce("c", "d", "p")
    return j.select(
        "doi", "pmid", hit["title"].alias("title"), (hit["full_text"] if budget is None else T.truncate(hit["full_text"], budget)).alias("text"),
        F.when(F.col("c").isNotNull(), "cache").when(hit.isNotNull(), "in_corpus").otherwise("fetch").alias("source"))
