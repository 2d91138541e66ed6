"""Answers of sequence repositories and literature services, as DataFrames.

Fetching is a callable `(key) -> text` the caller supplies; parsing and aggregation are Spark's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import accessions as A
from assaymill.operators.joins import left_lookup
from assaymill.session import cut
from assaymill.sources import pacing

Transport = Callable[[str], str | None]

RUN = ("sample_alias string, instrument_model string, library_strategy string, scientific_name string, "
       "read_count string")


def fetch(keys: DataFrame, key: str, transport: Transport, per_second: float | None = None,
          tries: int = 3, lanes: int = pacing.LANES) -> DataFrame:
    """`keys` with the service's `answer` (NULL after failed tries). `per_second` bounds the calls of the whole job, tries included."""
    fields = [f for f in keys.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["answer string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait = pacing.slots(per_second, lanes)

        def one(k):
            for _ in range(tries):
                wait()
                try:
                    return transport(k)
                except Exception:  # a failed fetch is a missing answer, tried again on the next run
                    continue
            return None

        for b in batches:
            yield b.assign(answer=[one(k) for k in b[key]])

    return pacing.dealt(keys, per_second, lanes, key).mapInPandas(run, schema)


def answered(wants: DataFrame, key: str, known: DataFrame, transport: Transport, per_second: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(`wants` with `answer`, the new `(key, answer)` rows to be stored).

    Equal wants become one call; what `known` `(key, answer)` has is not asked. The new answers are cut, so that handing them out
    and storing them makes no second call. Rows without a key, and those whose call failed, have no answer. Of several known
    answers to a key the largest counts. A column `answer` of `wants` is replaced.
    """
    known = known.where("answer IS NOT NULL").groupBy(key).agg(F.max("answer").alias("answer"))
    asked = wants.where(F.col(key).isNotNull()).select(key).distinct()
    new = cut(fetch(not_cached(asked, known, key), key, transport, per_second).where("answer IS NOT NULL"))
    return left_lookup(wants.drop("answer"), known.unionByName(new), [key]), new


def not_cached(keys: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """What is not on storage yet."""
    return keys.join(cached.select(key).distinct(), key, "left_anti")


def runs_from_json(answers: DataFrame) -> DataFrame:
    """Run rows of JSON answers `(accession, answer)`."""
    return answers.select("accession", F.inline(F.from_json("answer", f"array<struct<{_fields(RUN)}>>")))


def _fields(ddl: str) -> str:
    return ", ".join(f.strip().replace(" ", ":", 1) for f in ddl.split(","))


def runs_from_csv(answers: DataFrame) -> DataFrame:
    """Run rows of comma-separated answers with a header line."""
    a = answers.withColumn("_l", F.filter(F.split(F.trim("answer"), "\n"), lambda l: F.trim(l) != ""))
    a = a.where((F.size("_l") >= 2) & F.get("_l", F.lit(0)).contains("Run"))
    head = F.split(F.get("_l", F.lit(0)), ",")
    r = a.select("accession", head.alias("_h"), F.explode(F.slice("_l", F.lit(2), F.size("_l"))).alias("_r"))
    r = r.withColumn("_v", F.split("_r", ","))

    def field(name):
        at = F.array_position("_h", name)
        return F.when(at > 0, F.get("_v", (at - 1).cast("int")))

    return r.select(
        "accession", F.coalesce(F.nullif(field("SampleName"), F.lit("")), field("Sample")).alias("sample_alias"),
        field("Model").alias("instrument_model"), field("LibraryStrategy").alias("library_strategy"),
        F.lit(None).cast("string").alias("scientific_name"), F.lit(None).cast("string").alias("read_count"))


def aggregate_runs(runs: DataFrame) -> DataFrame:
    """One record per accession: distinct samples, sorted instruments and organisms, reads, data type.

    Instruments, organisms and strategies are controlled vocabularies, so their sets stay small; samples are counted.
    """
    def listed(c):
        names = F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit(""))))
        return F.nullif(F.array_join(names, ", "), F.lit(""))

    return runs.groupBy("accession").agg(
        F.countDistinct(F.nullif(F.col("sample_alias"), F.lit(""))).alias("sample_count"),
        listed("instrument_model").alias("platform"), listed("scientific_name").alias("organism"),
        A.library_data_type(F.collect_set(F.nullif(F.col("library_strategy"), F.lit("")))).alias("data_type"),
        F.coalesce(F.sum(F.col("read_count").try_cast("bigint")), F.lit(0)).alias("total_reads"))


def study_from_json(answers: DataFrame) -> DataFrame:
    """(accession, project_title, sample_count) of study answers; samples are the links of its Samples section."""
    schema = ("title string, section struct<subsections:array<struct<type:string,links:array<string>>>>")
    a = answers.select("accession", F.from_json("answer", schema).alias("j")).where("j IS NOT NULL")
    sections = F.filter("j.section.subsections", lambda s: s["type"] == "Samples")
    return a.select("accession", F.coalesce("j.title", F.lit("")).alias("project_title"),
                    F.coalesce(F.size(F.try_element_at(sections, F.lit(-1))["links"]), F.lit(0)).alias("sample_count"))


def document_summaries(answers: DataFrame, column: str = "answer") -> DataFrame:
    """Article summaries `(pmc_id, pmid, doi, title, journal, pub_date, authors)` of a literature service."""
    docs = answers.select(F.explode(F.regexp_extract_all(
        column, F.lit(r"(?s)<DocumentSummary\b.*?</DocumentSummary>"), F.lit(0))).alias("d"))

    def field(tag):
        return F.nullif(F.regexp_extract("d", rf"(?s)<{tag}>(.*?)</{tag}>", 1), F.lit(""))

    def article_id(kind):
        return F.nullif(F.regexp_extract(
            "d", rf"(?s)<ArticleId>\s*<IdType>{kind}</IdType>\s*<Value>(.*?)</Value>", 1), F.lit(""))

    return docs.select(
        field("Id").alias("pmc_id"), article_id("pmid").alias("pmid"), article_id("doi").alias("doi"),
        field("Title").alias("title"), F.coalesce(field("FullJournalName"), field("Source")).alias("journal"),
        F.coalesce(field("PubDate"), field("EPubDate")).alias("pub_date"),
        F.regexp_extract_all("d", F.lit(r"(?s)<Author>\s*<Name>(.*?)</Name>"), F.lit(1)).alias("authors"))


def linked_series(answers: DataFrame) -> DataFrame:
    """(paper_id, accession, title) of series named in link answers `(paper_id, answer)`."""
    d = answers.select("paper_id", F.explode(F.regexp_extract_all(
        "answer", F.lit(r"(?s)<DocumentSummary\b.*?</DocumentSummary>"), F.lit(0))).alias("d"))
    named = d.select("paper_id", F.regexp_extract("d", r"<Accession>(GSE\d+)</Accession>", 1).alias("accession"),
                     F.regexp_extract("d", r"(?s)<[Tt]itle>(.*?)</[Tt]itle>", 1).alias("title")).where("accession <> ''")
    loose = answers.select("paper_id", F.explode(A.find_all(F.col("answer"))).alias("accession"),
                           F.lit("").alias("title")).where(F.col("accession").startswith("GSE"))
    return named.unionByName(loose).groupBy("paper_id", "accession").agg(F.max("title").alias("title"))


def batches(ids: DataFrame, key: str, n_batches: int) -> DataFrame:
    """Ids in about equal batches for one call each, by hash: no numbering and no count is needed for that."""
    return ids.withColumn("batch", F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n_batches)))
