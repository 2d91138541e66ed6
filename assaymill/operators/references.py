"""Texts of references: from the cache, else the corpus, else a service that is asked once per reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.operators import search
from assaymill.session import cut
from assaymill.sources import repositories

ANSWER = "title string, text string, pmc_id string"
PMID_KEY = "pmid:"


def fetch_references(requests: DataFrame, cache: DataFrame, papers: DataFrame, transport: repositories.Transport, budget: int | None = None,
                     per_second: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(`doi, pmid, title, text, source` of each request, new rows of the cache).

    `source` is cache, in_corpus, fetched or not_found. The transport gets a DOI, or `pmid:` and the number where there is none, and gives
    `{"title", "text", "pmc_id"}` as JSON; each key is asked once however many papers want it. A request with neither is not asked.
    Answers that are no such JSON or hold no text count as not found, and are asked again on the next run.
    """
    asked = requests.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in ("doi", "pmid")])
    have = cut(search.reference_texts(asked, cache, papers, budget))
    key = F.coalesce("doi", F.concat(F.lit(PMID_KEY), "pmid"))
    open_ = have.where("source = 'fetch'").select("doi", "pmid", key.alias("key"))
    none = open_.sparkSession.createDataFrame([], "key string, answer string")
    answered, answers = repositories.answered(open_, "key", none, transport, per_second)
    fields = F.from_json("answer", ANSWER)
    text = F.nullif(fields["text"], F.lit(""))
    got = answered.select("doi", "pmid", F.when(text.isNotNull(), fields["title"]).alias("title"), (text if budget is None else T.truncate(text, budget)).alias("text"),
                          F.when(text.isNotNull(), "fetched").otherwise("not_found").alias("source"))
    new = answers.select(F.when(~F.startswith("key", F.lit(PMID_KEY)), F.col("key")).alias("doi"), fields["pmc_id"].alias("pmc_id"),
                         fields["title"].alias("title"), text.alias("full_text"), F.lit("fetch_reference").alias("source"))
    return have.where("source <> 'fetch'").unionByName(got), new.where("full_text IS NOT NULL")


def written_back(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with fetched rows: they replace rows of their DOI, which had no text, and keep a title or PMC id that only those had."""
    was = cache.where("doi IS NOT NULL").groupBy("doi").agg(F.max("title").alias("_title"), F.max("pmc_id").alias("_pmc"))
    fresh = new.join(was, "doi", "left").select(
        "doi", F.coalesce(F.nullif("pmc_id", F.lit("")), "_pmc").alias("pmc_id"), F.coalesce(F.nullif("title", F.lit("")), "_title").alias("title"),
        "full_text", "source", F.current_timestamp().alias("cached_at"))
    return cache.join(new.select("doi").where("doi IS NOT NULL"), "doi", "left_anti").unionByName(fresh, allowMissingColumns=True)
